import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidecast.llm import queries
from tidecast.llm.common import table
from tidecast.llm.packing import Encoder, nnls, packed, plan_tails, tail_pieces


def check(rows, texts, window):
    """Every id of every text in one piece, sequences gapless, no padding."""
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = np.array([*whole.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] >= 1 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert set(sequences) == set(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0


@pytest.mark.parametrize("window", [8, 64, 1024])
def test_documents(spark, sf_dir, window):
    docs = table(spark, sf_dir, "documents")
    check(packed(docs, window=window).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, window)


def test_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check(queries.op5_packing(spark, sf_dir).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, 1024)


def test_edge_rows(make_docs):
    texts = {1: None, 2: "", 3: "word " * 100_000, 4: "a <|endoftext|> b", None: "no id", **{k: "same text here" for k in range(10, 60)}}
    check(packed(make_docs(list(texts.items()), clashing=True), window=64).collect(), texts, 64)
    assert packed(make_docs([(1, "a")]).limit(0)).collect() == []
    twice = packed(make_docs([(1, "some words")] * 5), window=64).collect()
    assert sum(r["length"] for r in twice) == 5 * twice[0]["doc_tokens"]


def test_both_encoders_agree(spark, sf_dir):
    own = Encoder("byte_bpe_50k")
    for r in table(spark, sf_dir, "documents").collect():
        assert own.ids(r["text"]).tolist() == own.whole.encode(r["text"], add_special_tokens=False).ids


def test_least_squares():
    columns = np.array([[6, 2, 0], [4, 4, 0], [3, 3, 2]])
    counts = np.zeros(8)
    counts[[6, 2, 4, 3]] = [10, 15, 8, 10]
    assert np.allclose(nnls(columns, counts), [10, 4, 5], atol=1e-2)


@pytest.mark.parametrize("seed", range(4))
def test_every_tail_has_one_place(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(64, np.int64)
    counts[rng.integers(1, 64, 30)] = rng.integers(1, 50, 30)
    counts[40] = 500 * (seed % 2)  # a hot length
    plan = plan_tails(counts, 64, triples=50)
    seen = defaultdict(list)
    for length in range(1, 64):
        for rank in range(counts[length]):
            own = tail_pieces(plan, length, rank, plan.cuts())
            assert sum(x[1] for x in own) == length
            for _, size, sequence, offset in own:
                seen[sequence].append((offset, size))
    assert set(seen) == set(range(plan.sequences))
    for own in seen.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= 64 and at & (at - 1) == 0
