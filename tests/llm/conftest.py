import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from ``(id, text, source)`` or ``(id, text)``."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


LONG = "word " * 30_000

#: Null, empty, blank, very long and repeated texts, a null id, repeated rows.
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "two words"),
    (5, LONG), (6, "a b c d e f g h. 😀 ñ"), (7, "a b c d e f g h. 😀 ñ"), (8, "\x00 \x0b end"),
]


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)
