import pytest
from pyspark.sql import types as T

#: Null and empty texts, no letters, ties, repeated rows, null keys, odd white space, a very
#: long text, a special token's string; columns whose names operators might use themselves.
LONG = " ".join(f"word{i % 977}{'abc'[i % 3]}" for i in range(60_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs.\nHome, then out.", "en", "a", 5),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, "  12 34 !! \t\n", "en", "b", 1),
    (5, "the quick brown fox jumps over the lazy dog and runs.\nHome, then out.", None, None, 7),
    (5, "the quick brown fox jumps over the lazy dog and runs.\nHome, then out.", None, None, 7),
    (6, "Der schnelle braune Fuchs springt über den faulen Hund und läuft fort.", "de", "c", 8),
    (None, "Ein weiterer Satz ohne Schlüssel, der über das Land läuft und geht.", "de", "c", 9),
    (7, "x", "de", "", 1),
    (8, LONG, "en", "a", 2),
    (9, "a<|endoftext|>b  c\u00a0 \u00a0d\x1ce 😀 中文。don't", "en", "b", 3),
    (10, "The quick brown fox jumps over the lazy dog and runs.\nHome, then in.", "en", "a", 4),
]
FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ["_found", "_row", "key", "size", "fp", "kind", "score", "n_tokens", "sequence_id", "a.b"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ROWS, FIELDS)


@pytest.fixture(scope="session")
def clashing_docs(spark):
    """The same rows with further columns, whose names operators use themselves."""
    kind = T.StructType(
        [*T._parse_datatype_string(FIELDS).fields, *[T.StructField(x, T.StringType()) for x in CLASHING]]
    )
    return spark.createDataFrame([(*row, *CLASHING) for row in ROWS], kind)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], FIELDS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").persist()
