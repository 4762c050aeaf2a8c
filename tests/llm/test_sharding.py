import re
import zlib
from collections import Counter

import pytest
from llm.conftest import rows_of

from tidecast.llm.sharding import interleaved_shards


@pytest.fixture(scope="module")
def many(make_docs):
    rows = [(i, f"text {i % 40}", None, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"s{i % 5}") for i in range(1000)]
    return make_docs(rows, clashing=True), rows


@pytest.mark.parametrize("shards", [1, 7, 8])
def test_counts_slots_and_mixture(many, shards):
    docs, rows = many
    got = interleaved_shards(docs, shards=shards).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1000))
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 1
    for k in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == k) == list(range(sizes[k]))
    of = Counter(r[3] for r in rows)
    inside = Counter((r["shard"], r["stratum"]) for r in got)
    for source, n in of.items():
        for k in range(shards):
            assert abs(inside[k, source] - n / shards) <= 3


def test_strata_of_one_row_spread(make_docs):
    got = interleaved_shards(make_docs([(i, "t", None, f"alone{i}") for i in range(800)]), 8).collect()
    halves = Counter(r["shard"] for r in got if r["doc_id"] < 400)
    assert Counter(r["shard"] for r in got) == dict.fromkeys(range(8), 100)
    assert all(25 <= halves[k] <= 75 for k in range(8))


def test_sizes_and_checksums(make_docs):
    docs = make_docs([(1, "é"), (2, None), (3, ""), (None, "é"), (4, "x" * 300_000)], clashing=True)
    got = {r["doc_id"]: (r["size"], r["text_crc32"]) for r in interleaved_shards(docs, 2).collect()}
    crc = zlib.crc32("é".encode())
    assert got == {1: (3, crc), 2: (1, 0), 3: (1, 0), None: (3, crc), 4: (300_001, zlib.crc32(b"x" * 300_000))}


def test_repeatable_seeded_and_empty(many, make_docs):
    docs, _ = many
    assert rows_of(interleaved_shards(docs)) == rows_of(interleaved_shards(docs.repartition(5)))
    assert rows_of(interleaved_shards(docs)) != rows_of(interleaved_shards(docs, seed=7))
    assert interleaved_shards(docs.limit(0)).collect() == []
    twice = interleaved_shards(make_docs([(1, "a", None, "s")] * 9), 4).collect()
    assert sorted((r["shard"], r["slot"]) for r in twice) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (3, 1)]


def test_no_python_on_the_executors(many):
    plan = interleaved_shards(many[0])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
