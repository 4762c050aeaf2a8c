import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidecast.llm import queries
from tidecast.llm.best_fit import best_fit_packed, cut, plan_bins
from tidecast.llm.common import table


def check(rows, texts, window):
    """Every id of every text in one piece, only long texts cut, sequences gapless and within the window."""
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = np.array([*whole.encode(texts[doc] or "", add_special_tokens=False).ids, 0], "<u4")
        own.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["length"] == window or k == 0
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and len(own) == -(-len(ids) // window)
        total += at
    assert set(sequences) == set(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences), total


def one_by_one(counts, window):
    """Gaps left by the same method, piece after piece."""
    third = window // 3
    large = sorted((n for n in range(third + 1, window + 1) for _ in range(counts[n])), reverse=True)
    gaps = []
    while large:
        first = large.pop(0)
        partner = next((p for p in large if p <= window - first), 0)
        if partner:
            large.remove(partner)
        gaps.append(window - first - partner)
    for length in range(third, 0, -1):
        for _ in range(counts[length]):
            fits = [g for g in gaps if g >= length]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - length)
            else:
                gaps.append(window - length)
    return sorted(gaps)


def filled(counts, window):
    """Gaps after every piece has been placed by the plan's rules; places must not overlap."""
    plan = plan_bins(counts, window)
    rules = plan.table()
    lengths = np.repeat(np.arange(window + 1), counts)
    rule = np.searchsorted(rules[:, 0], np.arange(len(lengths)), "right") - 1
    nth = np.arange(len(lengths)) - rules[rule, 0]
    places = defaultdict(list)
    for length, r, k in zip(lengths.tolist(), rule.tolist(), nth.tolist()):
        _, sequence, per, offset, of = rules[r].tolist()
        assert of == length
        places[sequence + k // per].append((offset + k % per * length, length))
    assert set(places) == set(range(plan.sequences))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
    return sorted(window - sum(x[1] for x in own) for own in places.values())


@pytest.mark.parametrize("seed", range(12))
def test_runs_fill_as_one_by_one(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([7, 16, 33, 64]))
    counts = np.zeros(window + 1, np.int64)
    counts[rng.integers(1, window + 1, 20)] = rng.integers(1, 25, 20)
    counts[rng.integers(1, window + 1)] = 300  # a hot length
    assert filled(counts, window) == one_by_one(counts, window)


def test_matching_leaves_the_fewest_sequences():
    """Against the best of all ways to pair a few large pieces."""

    def fewest(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        best = 1 + fewest(rest)
        for i, p in enumerate(rest):
            if first + p <= 30:
                best = min(best, 1 + fewest(rest[:i] + rest[i + 1 :]))
        return best

    rng = np.random.default_rng(5)
    for _ in range(60):
        large = rng.integers(11, 31, 8).tolist()
        assert plan_bins(np.bincount(large, minlength=31), 30).sequences == fewest(large)


def test_plan_does_not_grow_with_the_pieces():
    counts = np.arange(257)[::-1].copy()
    counts[0] = 0
    small, large = plan_bins(counts, 256), plan_bins(counts * 10**7, 256)
    assert len(large.rules) < 1.2 * len(small.rules)
    assert large.sequences >= (counts * np.arange(257)).sum() * 10**7 // 256


def test_cut():
    assert [(a, len(b)) for a, b in cut(np.arange(20), 8)] == [(0, 4), (4, 8), (12, 8)]
    assert [(a, len(b)) for a, b in cut(np.arange(16), 8)] == [(0, 8), (8, 8)]
    assert [(a, len(b)) for a, b in cut(np.arange(1), 8)] == [(0, 1)]


@pytest.mark.parametrize("window", [8, 100, 2048])
def test_documents(spark, sf_dir, window):
    docs = table(spark, sf_dir, "documents")
    check(best_fit_packed(docs, window=window).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, window)


def test_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sequences, total = check(queries.op11_best_fit(spark, sf_dir).collect(), {r["doc_id"]: r["text"] for r in docs.collect()}, 2048)
    assert sequences <= 1.02 * -(-total // 2048)


def test_edge_rows(make_docs):
    texts = {1: None, 2: "", 3: "word " * 100_000, 4: "a <|endoftext|> b", None: "no id", **{k: "same text here" for k in range(10, 60)}}
    check(best_fit_packed(make_docs(list(texts.items()), clashing=True), window=64).collect(), texts, 64)
    assert best_fit_packed(make_docs([(1, "a")]).limit(0)).collect() == []
    twice = best_fit_packed(make_docs([(1, "some words")] * 5), window=64).collect()
    assert len(twice) == 5 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 5


def test_text_ids(make_docs):
    docs = make_docs([(k, "some words " * k) for k in range(9)]).selectExpr("'d' || doc_id AS doc_id", "text")
    assert {r["doc_id"] for r in best_fit_packed(docs, window=16).collect()} == {f"d{k}" for k in range(9)}
