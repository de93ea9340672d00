"""Small tables for the operators: nulls in every column, empty and long
texts, ties and repeated rows, and columns that clash with inner names."""

import random

import pytest
from llm_helpers import CLASHES, SCHEMA, prose
from pyspark.sql import functions as F

@pytest.fixture(scope="session")
def odd_rows():
    rng = random.Random(4)
    base = prose(rng, 60)
    near = base.split()
    near[30] = "changed"
    long = "\n".join(prose(rng, 400) for _ in range(100))
    texts = [base, base, " ".join(near), None, "", " \n\t ", "one", "two words", "!!! ...", "\n".join([base, prose(rng, 20), "short line"]),
             long, "é" * 3000, "Licensed under the MIT License.", "x" * 70_000, prose(rng, 8) + "\n" + prose(rng, 9)]
    rows = [(i, t, "ab"[i % 2], [None, "s1", "s0", "s0"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, None, None), (None, None, None, None, None), (3, "other text of the same id", "a", "s1", 25)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    return odd.select("*", *[F.lit(c).alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
