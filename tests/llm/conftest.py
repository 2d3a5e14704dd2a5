"""Small tables with the hard cases: nulls, empty and long texts, copies, repeated rows, clashing columns."""

import random

import pytest
from pyspark.sql import types as T

CLASH = "key name place stretch spans score base fp bands node bucket _key sequence_id offset range tie n_words rejected_by".split()


def sentence(rnd, n):
    return " ".join("".join(rnd.choice(["th", "er", "an", "in", "ou", "re", "é", "st"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    rnd = random.Random(7)
    common = sentence(rnd, 60)
    near = sentence(rnd, 300)
    words = near.split()
    rows = [
        (0, common), (1, sentence(rnd, 90) + " " + common), (2, common + "\n" + sentence(rnd, 80)), (3, near),
        (4, " ".join([*words[:150], "changed", *words[151:]])), (5, near), (5, near), (6, None), (7, ""), (8, "é" * 500), (9, "word"),
        (None, near + " tail"), (None, None), (10, "Mail joe.b@mail.example.com or +1 (017) 555-7713, 10.0.0.256 10.0.0.1; 4111 1111 1111 1111."),
        (11, "Same line here\n" * 40), (12, sentence(rnd, 20_000)), (13, "A B\x0bc d <|im_end|> <\\|x ### !!! ABC"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts, tmp_path_factory):
    """The rows as a stored table with columns whose names the operators use inside."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASH]
    )
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame([(*r, *["x"] * len(CLASH)) for r in texts], schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
