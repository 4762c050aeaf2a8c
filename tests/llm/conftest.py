"""Small tables for the corpus operators."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as extra columns they must neither break nor leak.
CLASHING = ("id", "key", "n", "bucket", "score", "label", "component_id", "spans", "tail", "gone", "row_of_id_0")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns of clashing names if asked for."""

    def make(rows, clashing=False):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        schema = COLUMNS
        if clashing:
            schema += "".join(f", {c} string" for c in CLASHING)
            full = [(*r, *[f"x{i}" for i in range(len(CLASHING))]) for r in full]
        return spark.createDataFrame(full, schema)

    return make


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
