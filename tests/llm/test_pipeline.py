"""Each stage against what it must do with the documents that reach it."""

import corpus_pipeline
import pytest
from llm.conftest import rows_of
from llm.test_decontamination import brute as brute_hits
from llm.test_jaccard import brute as brute_groups
from llm.test_packing import check
from llm.test_secret_scan import plain_spans

from tidecast.llm.common import saved, table
from tidecast.llm.queries import toxic_model
from tidecast.llm.signature_tree import Threshold
from tidecast.llm.toxicity import toxicity


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], sf_dir), name))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(steps):
    assert all(df.schema == steps[0].schema for df in steps[:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def test_toxic_documents_go(spark, sf_dir, steps):
    scored = toxicity(steps[0], toxic_model(spark, sf_dir)).collect()
    assert set(texts(steps[1])) == {r["doc_id"] for r in scored if r["score"] < 0.7}


def test_one_document_of_each_group_stays(steps):
    before = texts(steps[1])
    groups = brute_groups(list(before.items()), 5, Threshold(80, 100))
    assert set(texts(steps[2])) == {k for k, _, first in groups if k == first}


def test_benchmark_passages_are_cut(spark, sf_dir, steps):
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    before, after = texts(steps[2]), texts(steps[3])
    hit = {k for k, _, n, _ in brute_hits(list(before.items()), items, 10) if n}
    assert set(after) == set(before) and hit
    assert {k for k in before if before[k] != after[k]} == hit
    assert not any(n for _, _, n, _ in brute_hits([(k, after[k]) for k in hit], items, 10))


def test_secrets_are_masked(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert set(after) == set(before)
    assert {k for k in before if plain_spans(before[k])} <= {k for k in before if before[k] != after[k]}
    assert not any(plain_spans(t) for t in after.values())
    assert all(r["n_chars"] == len(r["text"]) for r in steps[4].collect())


def test_all_that_is_kept_is_packed(steps):
    check(steps[5].collect(), texts(steps[4]), 1024)


def test_run_gives_the_last_stage(spark, sf_dir, steps):
    assert rows_of(corpus_pipeline.run(spark, sf_dir)) == rows_of(steps[5])
