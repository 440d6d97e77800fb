import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, version long, fp string, k string"
# Extra columns named like the operators' own ones.
CLASH = ("r", "maybe", 7, "f", "key")


def prose(rng, n, words="the of and river stone light morning over under tall green walks sings slowly reads".split()):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and long texts, ties, repeated rows, shared keys, odd characters."""
    rng = random.Random(5)
    shared = "This licence line is shared by many of the documents here."
    texts = [prose(rng, 80 + i) + ("\n  " + shared.upper() + " \t" if i % 2 else "\n" + shared) for i in range(12)]
    texts += ["", None, "   \n\t\n", "a", "a b", "<|endoftext|> <|im_end|> Ünïcödé ÀÉ Σ\x1c ok", prose(rng, 40_000), texts[3], texts[3] + " end"]
    texts += [f"{prose(rng, 60)} #### $$ {i}" for i in range(4)]
    rows = [(i, t, ("en", "de", None)[i % 3], "s", len(t or ""), *CLASH) for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[2], (None, texts[4], "en", None, None, *CLASH), (None, None, None, None, None, *CLASH), (1, "another text", "en", "s", 3, *CLASH)]


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    return spark.createDataFrame(hard_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").where(F.lit(True))


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")
