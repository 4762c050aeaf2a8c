import hashlib
import re

import pytest
from llm.conftest import rows_of
from pyspark.sql import functions as F

from tidecast.llm import fingerprints
from tidecast.llm.fingerprints import LONGEST, edited_fingerprints


def paragraphs(text):
    return {p.lstrip(" ") for p in re.findall(rf"[^.!?\n]{{1,{LONGEST}}}[.!?]*|[.!?]+", text)} - {""}


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def wanted(rows):
    """rows: (id, text), ids unique."""
    out, ordered = {}, sorted((k, t or "") for k, t in rows)
    for i, (k, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, b = paragraphs(text), paragraphs(edited)
        out[k] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(a, b), likeness(a, paragraphs(following)), len(a - b), len(b - a))
    return out


def found(df):
    return {r["doc_id"]: (r["n_chars"], r["edited_sha256"], pytest.approx(r["near_edited"]), pytest.approx(r["near_next"]), len(r["lost"]), len(r["won"])) for r in df.collect()}


def test_documents_against_sets_of_paragraphs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert wanted([(r["doc_id"], r["text"]) for r in docs.collect()]) == found(edited_fingerprints(docs))


def test_equal_texts_have_equal_fingerprints_and_last_wraps(make_docs):
    docs = make_docs([(5, "One two. Three four."), (9, "Other words here. And more."), (-3, "One two. Three four.")])
    got = {r["doc_id"]: r for r in edited_fingerprints(docs).collect()}
    assert got[5]["fingerprint"] == got[-3]["fingerprint"] != got[9]["fingerprint"]
    assert got[-3]["near_next"] == 1.0
    assert got[9]["near_next"] == 0.0
    assert wanted([(5, "One two. Three four."), (9, "Other words here. And more."), (-3, "One two. Three four.")])[9][1] == got[9]["edited_sha256"]


def test_edge_rows(make_docs):
    long = " ".join(f"Sentence number {i} ends." for i in range(6000)) + "x" * 100_000
    docs = make_docs([(None, "First of all. Yes."), (1, None), (2, ""), (3, "é" * 7), (3, "é" * 7), (4, long)], clashing=True)
    got = rows_of(edited_fingerprints(docs).select("doc_id", "n_chars", "near_edited", "near_next"))
    assert [r[:2] for r in got] == sorted([(None, 18), (1, 0), (2, 0), (3, 7), (3, 7), (4, len(long))], key=repr)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2:] == (1.0, 1.0) and by_id[2][3] == 0.0
    edited = long[: len(long) - len(long) // 4] + "First of all. Yes."
    assert by_id[4][2] == pytest.approx(likeness(paragraphs(long), paragraphs(edited)))
    assert edited_fingerprints(docs.limit(0)).collect() == []


@pytest.mark.parametrize("schema, ids", [
    ("string", ["10", "9", None, "b"]), ("bigint", [-(1 << 63), 0, None, 4]), ("date", ["2024-01-02", "2023-12-31", None, "2024-01-01"])
])
def test_ids_of_any_type(spark, schema, ids):
    """The smallest long isn't the null id, and text ids go by their bytes."""
    texts = [f"Only here {i}. Shared by all." for i in range(4)]
    rows = spark.createDataFrame(list(zip([None if i is None else str(i) for i in ids], texts)), "doc_id string, text string")
    docs = rows.select(F.col("doc_id").cast(schema), "text")
    got = {r["doc_id"] if r["doc_id"] is None else str(r["doc_id"]): r["edited_sha256"] for r in edited_fingerprints(docs).collect()}
    order = sorted(range(4), key=lambda i: (ids[i] is not None, ids[i] or (0 if schema == "bigint" else "")))
    for at, i in enumerate(order):
        text, following = texts[i], texts[order[(at + 1) % 4]]
        cut = len(text) // 4
        assert got[None if ids[i] is None else str(ids[i])] == hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest()


def test_a_group_that_fails_gets_a_larger_sketch(spark):
    """Digests that share all cells of a group's first sketch peel in the larger one."""
    items = [0b111 | 0b111 << 10 | 0b111 << 20 | i << 3 | i << 13 | i << 24 for i in (1, 2, 3)]
    rows = spark.createDataFrame([(items,)], "l array<bigint>").withColumn("r", F.expr("cast(array() as array<bigint>)"))

    def peel(cells, shifts):
        return fingerprints._peeled(fingerprints._sketch_less("l", "r", cells, shifts), cells, shifts)

    got = rows.select(F.expr(peel(fingerprints.CELLS_OF_GROUP, fingerprints.SHIFTS_OF_GROUP)).alias("first"), F.expr(peel(fingerprints.CELLS_AGAIN, fingerprints.SHIFTS_AGAIN)).alias("again")).first()
    assert got["first"] is None and {x["k"] for x in got["again"]} == set(items)


def test_a_group_lists_its_filled_cells_only(spark):
    """Peeling tries no cell without digests, and digests that both sides have leave none."""
    left, right = [1 << 62 | 3, -5, 7 << 20 | 1 << 10, 12345678901], [-5, 101]
    rows = spark.createDataFrame([(left, right), (left, left), ([], [])], "l array<bigint>, r array<bigint>")
    sketch = fingerprints._sketch_less("l", "r", fingerprints.CELLS_OF_GROUP, fingerprints.SHIFTS_OF_GROUP)
    found = fingerprints._peeled(sketch, fingerprints.CELLS_OF_GROUP, fingerprints.SHIFTS_OF_GROUP)
    got, same, empty = rows.select(F.expr(sketch).alias("s"), F.expr(found).alias("found")).collect()
    assert all(1 <= len(t) <= 4 for t in got["s"]) and not any([*same["s"], *empty["s"]])
    assert {(d["k"], d["n"]) for d in got["found"]} == {(k, 1) for k in left if k != -5} | {(101, -1)}
    assert same["found"] == empty["found"] == []


def test_one_document_is_its_own_next(make_docs):
    (row,) = edited_fingerprints(make_docs([(1, "Aa bb cc dd. Ee ff.")])).collect()
    assert row["near_next"] == 1.0


def test_large_differences_peel_after_division(spark):
    """Thousands of differing digests, recovered whole though the first sketch has 48 cells."""
    rows = spark.createDataFrame([(list(range(0, 3000)), list(range(1000, 4500)))], "l array<bigint>, r array<bigint>")
    rows = rows.select(*[F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in ("l", "r")])
    rows = fingerprints.sketched(fingerprints.sketched(rows, "l", "lc"), "r", "rc")
    (got,) = fingerprints.compared(rows, "l", "r", "d", "lc", "rc").collect()
    left, right = set(got["l"]), set(got["r"])
    assert {x["k"] for x in got["d"] if x["n"] == 1} == left - right
    assert {x["k"] for x in got["d"] if x["n"] == -1} == right - left
    assert len(got["d"]) == 2500
    small = rows.select("l", F.slice("l", 5, 4000).alias("r"), "lc")
    small = fingerprints.sketched(small, "r", "rc").withColumn("first", F.expr(fingerprints._peeled(fingerprints._minus("lc", "rc"), fingerprints.CELLS, fingerprints.SHIFTS)))
    assert len(small.collect()[0]["first"]) == 4


def test_no_python_on_the_executors(spark, sf_dir):
    plan = edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
