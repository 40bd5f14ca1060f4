import pytest
from pyspark.sql import types as T

#: Names that the operators use inside, as extra columns of the input.
EXTRA = ("tag", "row", "c", "matches", "key", "size", "covered", "line", "spans")

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in EXTRA],
    ]
)


@pytest.fixture(scope="session")
def docs_of(spark):
    """(doc_id, text[, source]) to a documents table with clashing extra columns."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) + tuple(f"x{i}" for i in range(len(EXTRA))) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make


@pytest.fixture
def odd_rows():
    """Nulls, blanks, a very long text, repeated rows, repeated ids, ties."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(60_000))
    same = "one two three four five six seven eight nine ten\nline b of it\nline c of it\nline d of it"
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "word"), (5, same), (6, same), (6, same), (7, same + " eleven"),
        (None, same), (None, None), (8, long), (9, long + " end"), (10, "two words"), (10, "other text here"), (11, "é ß 漢字 \U0001f600"),
    ]
