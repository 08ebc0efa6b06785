"""Tables with everything a document table may hold."""

LONG = "long words of one text " * 20_000

DOCUMENTS = [
    (1, "The quick brown fox jumps over the lazy dog.", "a", 1.0), (1, "The quick brown fox jumps over the lazy dog.", "a", 1.0),
    (2, None, None, None), (3, "", "b", 2.0), (None, "a text without an id", "c", None), (4, LONG, None, 3.0),
    (5, " \n\t ", "d", 4.0), (6, "Ünïcödé 日本 😀 x", "e", 5.0), (7, "one", "f", 6.0),
]


def documents(spark, rows=DOCUMENTS):
    """Columns ``score``, ``fingerprint`` and the like clash with names the operators use."""
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, score double")
    return frame.selectExpr("*", "score AS fingerprint", "source AS component_id", "source AS row_number", "score AS found_values", "score AS length")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
