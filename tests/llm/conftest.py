import pytest

#: Column names that the operators use inside.
CLASHES = ("id", "row", "node", "n", "t", "size", "w", "name", "key", "stats", "base", "runs", "prefix", "taken", "p", "value", "i", "y", "copies", "_gone", "_row", "curve")


@pytest.fixture(scope="session")
def awkward(spark):
    """Rows of documents with nulls in any column, empty and very long texts, repeated rows, ties and clashing columns."""
    prose = " ".join(f"word{i % 97}x{i % 13} and" for i in range(120)) + "."
    rows = [
        (1, prose, "en", "a", len(prose)), (1, prose, "en", "a", len(prose)), (2, prose, None, None, None), (None, prose, "en", "b", 3),
        (3, None, "en", "a", 0), (4, "", "en", "a", 0), (5, " \t\n ", "en", None, 5), (6, "one", "en", "a", 3), (7, "one two", "en", "a", 7),
        (8, " ".join(f"w{i}" for i in range(60_000)), "en", "b", None), (9, "é" * 300 + "   ünï", "de", "c", 1), (None, None, None, None, None),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])
