import numpy as np
import pytest
from llm.conftest import rows_of

from tidecast.llm import queries
from tidecast.llm.common import table
from tidecast.llm.language import Filters, identified, learned_filters, trigrams

LEARN = [(1, "the cat and the dog sat on the mat", "en"), (2, "der Hund und die Katze sitzen auf der Matte", "de"), (3, "words of none", None), (4, None, "fr")]


@pytest.fixture(scope="module")
def filters(make_docs):
    return learned_filters(make_docs(LEARN))


def test_held_out_accuracy(spark, sf_dir):
    langs = {r["doc_id"]: r["lang"] for r in table(spark, sf_dir, "documents").collect()}
    rows = queries.op6_language(spark, sf_dir).collect()
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_rows(make_docs, filters):
    docs = make_docs([(1, None), (2, ""), (3, "12 34 !?"), (4, "The Dog"), (4, "The Dog"), (None, "die Katze"), (6, "und die " * 200_000), (7, "日本")], clashing=True)
    got = rows_of(identified(docs, filters).select("doc_id", "lang_pred"))
    assert got == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (None, "de"), (6, "de"), (7, "de")], key=repr)
    assert identified(docs.limit(0), filters).collect() == []


def test_nothing_learned(make_docs):
    none = learned_filters(make_docs(LEARN).limit(0))
    assert rows_of(identified(make_docs([(1, "the dog")]), none)) == [(1, "und", 0.0)]


def test_long_texts_count_as_their_parts(make_docs, filters):
    a = identified(make_docs([(1, "the cat " * 400_000)]), filters).collect()[0]
    b = identified(make_docs([(1, "the cat " * 400)]), filters).collect()[0]
    assert a["lang_pred"] == b["lang_pred"] and a["score"] == pytest.approx(b["score"], abs=1e-3)


def test_filters_hold_what_was_added_for_any_number_of_languages():
    rng = np.random.default_rng(1)
    own = Filters([f"l{k:03}" for k in range(130)], np.zeros((1 << 14, 3), np.uint64))
    sets = [rng.integers(0, 1 << 62, 40).astype(np.uint64) for _ in own.langs]
    for k, grams in enumerate(sets):
        own.add(k, grams)
    for k in (0, 63, 64, 129):
        hits = own.hits(sets[k], np.zeros(40, np.int64), 1)
        assert hits[0, k] == 40 and np.delete(hits[0], k).max() <= 5


def test_trigrams_stay_in_words():
    grams, of = trigrams(["aB c", "", "é"])
    assert of.tolist() == [0, 0, 0, 2]
    assert grams[0] == ord("a") << 21 | ord("b") << 42 and grams[2] == ord("c") << 21
