import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_fixtures import SCHEMA, prose  # noqa: E402

@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and blank texts, a very long one, repeated rows, ties."""
    rows = [(i, prose(i % 23, 40 + i % 7), ["en", "de"][i % 2], f"s{i % 3}", 5) for i in range(60)]
    rows += [(60, None, "en", "s0", 0), (61, "", None, None, None), (62, " \t\n ", "en", "s1", 4), (None, prose(3, 50), "en", None, 9)]
    rows += [(63, "word " * 30_000, "en", "s0", 1), (64, "x" * 100_000, "en", "s0", 1), (65, "É à ü 日本 😀\r\n.", "fr", "s2", 1)]
    return rows + rows[:5] + rows[:2]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns that have the names of results and of things in between."""
    from pyspark.sql import functions as F

    extra = "shard slot block epoch place block_slot score fp first h1 at label found x good count n root key mask _metadata".split()
    return odd.select("*", *[F.lit(7).alias(c) for c in extra])
