import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i * i % 97} and{i % 13}" for i in range(400))
ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, LONG, "en", "a", 1),
    (5, LONG, "en", "a", 1),
    (5, LONG, "en", "a", 1),
    (6, LONG + " tail", "de", "b", 1),
    (7, "Kelvin K cc-BY, General  PUBLIC\nlicense cc by é😀 ALL rights reserved", "fr", "b", 1),
    (8, "mail a@b.c_d@e.f x@y..z 1.2.3.4.5.6.7.8 300.1.1.1 +1 (234) 567-8901, 4111 1111 1111 1111", "fr", "c", 1),
    (9, "aaaa" * 60, "xx", "c", 1),
    (10, "a" * 49 + "ä", "xx", "c", 1),
    (None, LONG, "en", "a", 1),
    (11, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" 12 34', None, "c", 1),
    (12, "Word. word, 3.5 ... don't! ÄÖ.", "de", "c", 1),
    (13, "Stop <|ENDOFTEXT|> here, <|endoftext|>. <s> <0x41> ▁ \u3000 end ", "de", "c", 1),
    (14, "½ ① ²", "de", "c", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns with clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    clashes = ("size", "fp", "hits", "items", "kept", "range", "h", "number", "copy", "base", "added", "cell", "n_words")
    return df.withColumns({c: F.lit("x") for c in clashes})


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
