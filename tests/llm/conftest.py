import pytest

ODD = [
    (1, "alpha beta  gamma\n", "en", "a", 18),
    (2, "alphabeta gamma", "en", None, 15),
    (3, None, None, "b", None),
    (4, "", "fr", "b", 0),
    (5, " \t\r\n", "fr", "b", 4),
    (6, "été à <|endoftext|> Straße 東京 😀 x" * 3, "fr", "c", 0),
    (7, "The quick brown fox isn't here; it's gone.  Two  blanks. " * 900, "en", "a", 1),
    (8, "The quick brown fox isn't here; it's gone.  Two  blanks. " * 900, "en", "a", 1),
    (None, "no id at all", "en", "a", 1),
    (9, "repeated row", "en", "a", 12),
    (9, "repeated row", "en", "a", 12),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty, very long and repeated rows, and a column that clashes."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    for clash in ("id", "norm", "salt", "length", "piece", "sha", "key", "size", "text_sha256", "hash", "stays", "_k0", "_k1", "_k2", "_score", "_mixed", "_text", "_spans", "_rank", "row", "rank", "spans", "mixed", "score"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
