"""Small inputs with the cases that every corpus operator must define."""

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines int, score double, ids string, spans string"

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
PROSE = "One line of text that several documents share with each other.\nAnd a second line of the very same text, a little longer."


def docs(spark):
    """Nulls, empty, blank and very long texts, copies, repeated rows and ids,
    and extra columns named like columns the operators add."""
    rows = [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t \n"), (6, LONG), (7, LONG + " tail"),
        (8, "x" * 30_000), (None, PROSE), (None, None), (9, "é" * 700 + "日本語 😀"), (9, "another text with the id of its neighbour"),
        (10, "one"), (11, "one"), (12, "one two three four"),
    ]
    full = [(i, t, None, None if i == 2 else f"site{k % 3}", None, 7, 0.5, "a", None) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, DOC_SCHEMA)


def empty(spark, like=None):
    return spark.createDataFrame([], DOC_SCHEMA) if like is None else like.where(F.lit(False))


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
