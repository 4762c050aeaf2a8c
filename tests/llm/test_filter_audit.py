import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidecast.llm import filter_audit
from tidecast.llm.filter_audit import audited, copies, positional_counts, subset_survivors, survival_words

NAMES = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain_report(docs, labels):
    """Every order applied document by document."""
    marks = defaultdict(lambda: [False, False])
    for doc_id, quality, toxic in labels:
        marks[doc_id][0] |= quality == 1
        marks[doc_id][1] |= toxic == 1
    first = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    known = []
    for doc_id, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        good, toxic = marks[doc_id] if doc_id is not None else (False, False)
        known.append((part or "", fails, good, toxic))
    out, removed_by = [], Counter()
    for part in {k[0] for k in known}:
        rows = [k for k in known if k[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                redundant = sum(r[1][x] for r in rows) - len(gone)
                lone = sum(r[1][x] and sum(r[1].values()) == 1 for r in rows)
                removed_by[part, x] += len(gone)
                out.append([part, order, step, len(left), len(gone), redundant, lone, sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def report(spark, docs_df, labels):
    found = audited(docs_df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return sorted(tuple(r[c] for c in NAMES) for r in found.collect())


def words(n, distinct=None, more=""):
    return " ".join(f"w{i % (distinct or n)}" for i in range(n)) + more


ROWS = [
    (1, words(250), "en"),
    (2, words(250), "en"),  # a copy
    (3, words(250, more=" #"), "en"),
    (4, words(250, 60, " A" * 40), "en"),
    (5, words(199), "de"),
    (6, words(200), "de"),
    (7, words(200, 100), "de"),
    (8, words(200, 99), None),
    (9, None, None),
    (10, "", None),
    (11, " \t\n\x0b ", ""),
    (12, "É" * 97 + "ABC", "fr"),
    (13, "É" * 96 + "ABCD", "fr"),
    (14, words(300, more=" x|y"), "en"),
    (15, "W" + words(200_000, 3), "en"),
    (16, words(250, more=" w w W"), "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (3, 1, 0), (4, None, 1), (8, 1, None), (99, 1, 1), (9, 1, 1)]


def test_rows_of_every_kind(spark, make_docs):
    assert report(spark, make_docs(ROWS, clashing=True), LABELS) == plain_report(ROWS, LABELS)


def test_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    given = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    assert report(spark, docs, given) == plain_report(rows, given)


def test_ties_lost_ids_and_empty_tables(spark, make_docs):
    rows = [(1, "a", "en")] * 3 + [(2, "a", "en"), (None, "a", "en"), (None, "b", "de"), (None, "b", "de"), (7, "b", "de")]
    assert report(spark, make_docs(rows), [(1, 1, 1), (None, 1, 1)]) == plain_report(rows, [(1, 1, 1)])
    assert report(spark, make_docs(rows).limit(0), LABELS) == []
    assert report(spark, make_docs(ROWS[:3]), []) == plain_report(ROWS[:3], [])


@pytest.mark.parametrize("share", [0.001, 0.2, 1.1])
def test_copies_of_hot_and_rare_texts(spark, monkeypatch, share):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i % 40}" if i % 2 else f"own{i}") for i in range(300)]
    first = {}
    for i, key in rows:
        first.setdefault(key, i)
    got = copies(spark.createDataFrame(rows, "id long, key string"), "id", "key").collect()
    assert sorted((r["id"], r["copy"]) for r in got) == [(i, first[key] < i) for i, key in rows]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 100, 4097])
def test_carry_save_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    assert positional_counts(words).tolist() == [sum(int(w) >> b & 1 for w in words) for b in range(32)]


def test_words_hold_the_surviving_subsets():
    table = survival_words(5)
    for failed in range(32):
        assert [s for s in range(32) if int(table[failed]) >> s & 1] == [s for s in range(32) if not s & failed]


def test_other_filters_and_parts(spark):
    rows = [(k % 3, k % 2 == 0, None if k % 5 == 0 else k % 7 == 0, k % 4 == 0) for k in range(400)]
    flagged = spark.createDataFrame(rows, "source int, short boolean, odd boolean, bad boolean")
    got = {(r["part"], r["subset"]): (r["documents"], r["bad"]) for r in subset_survivors(flagged, ["short", "odd"], "source", ["bad"]).collect()}
    assert len(got) == 12
    for part, subset in got:
        left = [r for r in rows if r[0] == part and not (subset & 1 and r[1]) and not (subset & 2 and r[2])]
        assert got[part, subset] == (len(left), sum(r[3] for r in left))
    with pytest.raises(ValueError):
        subset_survivors(flagged, list("abcdef"), "source")
