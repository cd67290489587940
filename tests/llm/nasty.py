"""Documents that try an operator: nulls, empty and long texts, ties, repeats, clashing names."""

from pyspark.sql import types as T

#: Names that operators use inside or add.
CLASHES = ("score", "n_words", "hits", "items", "_text", "row", "gone", "tie", "fp", "rid", "_id", "blob", "path", "kept", "n_lines", "lang_pred", "main_text", "component_id", "id1", "text2")

LONG = " ".join(f"word{k % 977} and{k % 13}" for k in range(30_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, "word"),
    (3, "word"),
    (3, "another text under the same number"),
    (None, "a text without a number, long enough to count for something"),
    (None, None),
    (4, " \t\n \r\n"),
    (5, LONG),
    (6, LONG + " end"),
    (7, "x" * 5000),
    (8, "naïve café Straße 数据 🙂 ИЗ"),
    (9, "one\ntwo\none\ntwo\none\ntwo"),
    (10, "a\0b\0c and more"),
    (11, "12345 67890 --- !!!"),
    (2**53 + 1, "½ ² Ⅷ"),
    (-(2**60) - 1, '<p class="x><b><b><table><tr><li>' * 40 + "token=abcdef12 " * 300),
]


def documents(spark, texts=TEXTS):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in CLASHES]
    rows = [(i, t, "en" if (i or 0) % 2 else None, None, len(t) if t is not None else None, *("kept" for _ in CLASHES)) for i, t in texts]
    return spark.createDataFrame(rows, T.StructType(fields))


def empty(spark):
    return documents(spark).where("false")
