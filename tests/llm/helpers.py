"""Small tables with everything an operator has to put up with."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 12000

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves, and one that differs in case only.
    *[T.StructField(name, T.StringType()) for name in (
        "TEXT", "id", "row", "node", "key", "bands", "shard", "slot", "size", "lang_pred", "score", "words", "ids",
        "class_row", "component", "u", "d", "a.b")]])

ODD_TEXTS = [(1, "One two three."), (1, "One two three."), (None, "One two three."), (2, None), (3, ""), (4, LONG),
             (5, " \t\n"), (6, "!?"), (7, "naïve Straße 中文 🙂 é"), (8, "\x00\x01 á")]


def documents(spark, rows, lang="en"):
    """Documents from (doc_id, text), or (doc_id, text, lang), with the other columns filled."""
    full = [(row[0], row[1], row[2] if len(row) > 2 else lang, "src", len(row[1] or "")) + ("x",) * 18 for row in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_documents(spark):
    return documents(spark, ODD_TEXTS)


def no_documents(spark):
    return documents(spark, [])


def by_id(frame):
    """Rows by their first column."""
    found = {}
    for row in frame.collect():
        found.setdefault(row[0], []).append(tuple(row[1:]))
    return found
