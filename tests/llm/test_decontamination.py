import random
import re
import tracemalloc

import numpy as np
import pytest
from llm.conftest import rows_of

from tidecast.llm import decontamination
from tidecast.llm.decontamination import benchmark_hits, cut_words, phrases, search_shard, without_benchmark, words_of
from tidecast.llm.fm_index import FMIndex, suffix_order

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + window]), set()).update(() if item is None else {str(item)})
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def flat(df):
    return sorted(((r[0], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)] + ["É", "日本"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)] + [(None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (20, None), (21, "-- ,"), (3, "w5 w5 w5")]
    docs = []
    for k in range(60):
        text = rng.choices(words, k=rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = (rng.choice(items)[1] or "").split()
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(text).upper() if k % 3 else " ".join(text)))
    return docs, items


@pytest.mark.parametrize("window", [1, 3, 10])
def test_against_brute_force(make_docs, spark, corpus, window):
    docs, items = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert flat(benchmark_hits(make_docs(docs), bench, window)) == brute(docs, items, window)


def test_blocks_and_shards_give_the_same(make_docs, spark, corpus, monkeypatch):
    docs, items = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 50)
    assert flat(benchmark_hits(make_docs(docs), bench, 10)) == brute(docs, items, 10)


def test_edge_rows(make_docs, spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(1, None), (2, ""), (3, "x " * 300_000 + passage), (4, passage), (4, passage), (None, passage)]
    bench = spark.createDataFrame([(8, passage), (8, passage), (10, passage)], "item_id long, text string")
    frame = make_docs(docs, clashing=True)
    assert flat(benchmark_hits(frame, bench)) == brute(docs, [(8, passage), (10, passage)], 10)
    assert all(r["spans"] == [] and r["items"] == [] for r in benchmark_hits(frame, bench.limit(0)).collect())
    assert benchmark_hits(frame.limit(0), bench).collect() == []


def test_cut_texts(make_docs, spark):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = make_docs([(1, f"before, {passage}. after"), (2, "clean text"), (3, None), (4, passage), (4, passage)], clashing=True)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = without_benchmark(docs, bench)
    assert out.schema == docs.schema
    got = rows_of(out.select("doc_id", "text", "n_chars"))
    assert got == [(1, "before, \n. after", 16), (2, "clean text", 10), (3, None, None), (4, "\n", 1), (4, "\n", 1)]
    assert rows_of(without_benchmark(docs, bench.limit(0))) == rows_of(docs)


def test_blocks_are_cut_on_the_given_text(make_docs, spark, corpus, monkeypatch):
    docs, items = corpus
    run = [f"p{i}" for i in range(17)]
    docs = docs + [(100, " ".join(["before", *run, "after"])), (101, "a b c " + " ".join(run[:12]) + " d e f")]
    items = items + [(30, " ".join(run[:12])), (31, " ".join(run[5:])), (32, "a b c d e f")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = make_docs(docs, clashing=True)
    whole = rows_of(without_benchmark(frame, bench))
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in benchmark_hits(frame, bench).collect()}
    assert {r[0]: r[1] for r in whole} == {k: cut_words(t, spans[k]) if spans[k] else t for k, t in docs}
    assert {r[0]: r[1] for r in whole if r[0] >= 100} == {100: "before \n after", 101: "a b c \n d e f"}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 50)
    out = without_benchmark(frame, bench)
    assert out.schema == frame.schema
    assert rows_of(out) == whole


def test_one_index_a_shard_over_all_its_words(monkeypatch):
    built = []

    class Counted(FMIndex):
        def __init__(self, symbols, sigma):
            built.append(symbols)
            super().__init__(symbols, sigma)

    monkeypatch.setattr(decontamination, "FMIndex", Counted)
    texts = [words_of(f"some words before k{i} k{i + 1} k{i + 2} and after") for i in range(30)] + [[]]
    blocks = [phrases([(str(b), f"k{b} k{b + 1} k{b + 2}")], 3) for b in range(20)]
    spans, items = search_shard(blocks, texts)
    assert len(built) == 1
    assert int((built[0] > 0).sum()) == sum(map(len, texts))
    assert [s for s in spans] == [[(3, 6)]] * 20 + [[]] * 11
    assert items == [[str(b)] for b in range(20)] + [[]] * 11


def test_memory_of_a_shard_by_its_words():
    # the tasks of an executor each hold a shard beside its heap
    rng = random.Random(11)
    words = [f"word{i}" for i in range(20_000)]
    passage = " ".join(words[:12])
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(500)] + [passage]

    class Given:
        shard_words = 1 << 20

        def each(self):
            yield phrases([("7", passage)], 10)

    list(decontamination.search(iter(texts[:5]), Given()))
    tracemalloc.start()
    results = list(decontamination.search(iter(texts), Given()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert results[-1] == (12, [(0, 12)], ["7"]) and [n for n, _, _ in results[:500]] == [400] * 500
    assert peak < 80 * 200_000


def test_batches_are_cut_a_few_texts_at_a_time(make_docs, spark, corpus, monkeypatch):
    docs, items = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = make_docs([*docs, (70, None), (71, "")], clashing=True).repartition(1)
    whole = rows_of(without_benchmark(frame, bench))
    monkeypatch.setattr(decontamination, "TEXTS_HELD", 7)
    monkeypatch.setattr(decontamination, "WINDOWS_HELD", 3)
    monkeypatch.setattr(decontamination, "SHARD_WORDS", 100)
    assert rows_of(without_benchmark(frame, bench)) == whole
    assert flat(benchmark_hits(frame, bench)) == brute([*docs, (70, None), (71, "")], items, 10)


def test_order_of_repeated_texts():
    rng = np.random.default_rng(5)
    for sigma in (2, 3, 50, 3_000_000):
        run = rng.integers(1, sigma, 60)
        text = np.concatenate([x for k in range(8) for x in (run[: 60 - k % 3], [0])])
        separators = np.cumsum(text == 0)
        key = [(0, int(separators[i])) if c == 0 else (1, int(c)) for i, c in enumerate(text)]
        assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: key[i:])
    assert suffix_order(np.zeros(0, np.int64)).tolist() == []


def test_words_and_cuts():
    assert words_of("Ab-9é É_x") == ["ab", "9é".encode(), "É".encode(), "x"] or words_of("Ab-9é É_x") == [w.encode() for w in ("ab", "9é", "É", "x")]
    assert cut_words("a b c d e", [(1, 3)]) == "a \n d e"


def test_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(3)
    for _ in range(20):
        text = rng.integers(0, 6, 400)
        text[-1] = 0
        assert sorted(suffix_order(text).tolist()) == list(range(400))
        index = FMIndex(text, 6, sample=5)
        patterns = rng.integers(1, 6, (40, 3))
        of, at = index.occurrences(patterns)
        want = {(k, i) for k, p in enumerate(patterns.tolist()) for i in range(398) if text[i : i + 3].tolist() == p}
        assert set(zip(of.tolist(), at.tolist())) == want
