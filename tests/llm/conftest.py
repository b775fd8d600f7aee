import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark, sf):
    """Rows of the smallest table, ``(doc_id, text)``."""
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def frame(spark):
    """A documents table of ``(doc_id, text)`` rows, in a few partitions."""

    def build(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return build


#: Nulls in either column, empty, blank and very long texts, repeated rows, and ties.
AWKWARD = [
    (None, None), (None, ""), (1, None), (2, ""), (3, "  \n\t "), (4, "a"), (4, "a"), (5, "A"), (6, "x" * 50_000),
    (7, "one two three four five six seven\n" * 900), (8, "é ü ß \U0001f600 日本"), (None, "a"), (9, "word " * 3),
]
