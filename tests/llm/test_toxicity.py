import random
import tracemalloc

import numpy as np
import pytest

from tidecast.llm import queries
from tidecast.llm.common import table
from tidecast.llm.toxicity import Chosen, Swaps, fit_weights, learned_model, present, toxicity, without_toxic


@pytest.fixture(scope="module")
def learned(spark, make_docs):
    rng = np.random.default_rng(4)
    plain = [f"word{k}" for k in range(200)]
    rows, marks = [], []
    for k in range(400):
        text = list(rng.choice(plain, 12))
        toxic = k % 4 == 0
        if toxic:
            text += ["idiot", "muslim" if k % 8 == 0 else "awful"]
        elif k % 10 == 1:
            text += ["christian"]
        rows.append((k, " ".join(rng.permutation(text)) + ("." if k % 2 else "")))
        marks.append((k, int(toxic)))
    labels = spark.createDataFrame([*marks, (None, 1), (3, None), (7, 0)], "doc_id long, toxic int")
    return make_docs(rows), labels, learned_model(make_docs(rows), labels)


def test_neutral_mentions_stay_low(learned, make_docs):
    _, _, model = learned
    texts = [(1, "word3 muslim word9"), (2, "word3 christian word9"), (3, "word1 idiot word2 jewish"), (4, "word1 idiot word2")]
    got = {r["doc_id"]: r for r in toxicity(make_docs(texts), model).collect()}
    assert [got[k]["predicted"] for k in (1, 2, 3, 4)] == [0, 0, 1, 1]
    assert abs(got[1]["score"] - got[2]["score"]) < 0.1


def test_penalty_holds_swapped_scores_together():
    rows = [(1, [0, 1])] * 20 + [(0, [2])] * 20 + [(1, [0])] * 5
    free, _ = fit_weights(rows, [], 3)
    tied, _ = fit_weights(rows, [([1], [2])] * 10, 3, swap=10.0)
    assert abs(tied[1] - tied[2]) < 0.2 < abs(free[1] - free[2])


def test_edge_rows(learned, make_docs, spark):
    docs, labels, model = learned
    rows = make_docs([(1, None), (2, ""), (3, "idiot " * 100_000), (3, "idiot " * 100_000), (None, "word1")], clashing=True)
    got = toxicity(rows, model).collect()
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2)}
    assert len(got) == 5 and len(empty) == 1 and 0 <= empty.pop() < 0.5
    assert [r["predicted"] for r in got if r["doc_id"] == 3] == [1, 1]
    assert toxicity(rows.limit(0), model).collect() == []
    kept = without_toxic(rows, model)
    assert kept.schema == rows.schema and sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 2, None]
    assert learned_model(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity(rows, None).collect()} == {0.0} and without_toxic(rows, None).count() == 5
    one_class = learned_model(docs, labels.where("toxic = 0"))
    assert {r["predicted"] for r in toxicity(rows, one_class).collect()} == {0}


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    marks = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    rows = queries.op9_toxicity(spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    toxic = [r["predicted"] for r in held if marks[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not marks[r["doc_id"]]]
    assert np.mean(toxic) >= 0.6 and np.mean(clean) <= 0.01
    assert all((r["predicted"] == 1) == (r["score"] >= 0.7) for r in rows)


def test_swaps_and_counts():
    own = Swaps()
    assert own.of("A Woman sang.") == ["a man sang.", "a  sang."]
    assert own.of("the manual") == []
    of, found = present(["abcd abcd", "abcd"])
    assert len(set(found[of == 0].tolist()) - set(found[of == 1].tolist())) > 0


def test_memory_of_features_by_their_texts():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(150)) for _ in range(1000)]
    chosen = Chosen(np.arange(0, 1 << 20, 256))
    alone = [present([t], chosen)[1].tolist() for t in texts[:300:50]]
    tracemalloc.start()
    of, found = present(texts, chosen)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [found[of == i].tolist() for i in range(0, 300, 50)] == alone
    assert peak < 45 * sum(map(len, texts))
