from __future__ import annotations

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Names that operators use inside; an input may have columns of these names.
CLASHING = ["size", "h", "fp", "id", "block", "word", "row", "key", "range", "late", "root", "taken", "score", "rest", "words", "place"]
SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        *[StructField(c, StringType()) for c in CLASHING],
    ]
)


def _prose(rng: random.Random, words: int) -> str:
    parts = ["er", "th", "ion", "an", "ou", "le", "st", "ré", "ß", "ti"]
    made = ["".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words)]
    return " ".join(w + (rng.choice([".", ",", "\n"]) if rng.random() < 0.1 else "") for w in made)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, exact and near copies, repeated rows and ids."""
    rng = random.Random(5)
    passage = _prose(rng, 60)
    long_ = _prose(rng, 9000)
    near = _prose(rng, 150)
    texts = [_prose(rng, rng.randint(1, 120)) for _ in range(20)]
    texts += ["", None, " \n\t ", "x", "ab " * 400, "a" * 3000, long_, long_, passage, texts[0], texts[1]]
    texts += [f"{_prose(rng, 30)} {passage} {_prose(rng, 20)}" for _ in range(4)]
    texts += [near, near.replace("er", "eru", 1), near + " end", "Mixed CASE words And mixed case WORDS 日本語 𝄞𝄞 " * 5]
    rows = [[i, t, rng.choice(["en", "fr", None]), rng.choice(["b", "a", "é", None]), len(t or "")] for i, t in enumerate(texts)]
    rows[3][4] = None
    rows += [[None, texts[2], None, None, None], [None, None, None, None, None], list(rows[4]), list(rows[4]), [5, "another text of id five " * 12, "en", "a", 1]]
    return [tuple(r + ["x"] * len(CLASHING)) for r in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
