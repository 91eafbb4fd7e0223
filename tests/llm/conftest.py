import random

import pytest

SMALL = "/root/testdata/sf0.001"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, repeated, very long, near-copied and exactly copied rows."""
    rng = random.Random(3)
    base, other = words(rng, 120), words(rng, 150)
    near = base.split()
    near[60] = "changed"
    return [
        (1, base, "en", "src0"), (2, base, "en", "src1"), (3, " ".join(near), "en", "src1"),
        (4, other, "fr", None), (4, other, "fr", None), (5, None, "de", "src2"), (6, "", None, "src2"), (7, " \n\t ", "es", "src3"),
        (None, words(rng, 90), None, None), (None, base, "en", "src0"), (8, words(rng, 30000), "en", "src0"),
        (9, "x", "en", "src0"), (10, "Ünïcode 漢字 😀 ñ " * 30, "xx", "weird"), (11, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ok', "en", "src4"),
        (12, "1234 !!! ???", "en", "src4"),
    ]


SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = ("n_words", "kept", "score", "lang_pred", "spans", "rid", "length", "piece", "class_id", "class", "leaf", "words", "w",
            "n_tokens", "topic", "mix_kept", "data", "sha", "key", "text_hash", "weight", "chars", "block")


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
