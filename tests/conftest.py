import os
import sys

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")  # before numpy: its threads may not outlive the start of the JVM

import pytest  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparktab.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", spark__sql__shuffle__partitions="2")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def gaps(spark):
    """A double with NULL and NaN, a constant, a text with NULL."""
    nan = float("nan")
    rows = [(1, 1.0, 7.0, "a"), (2, nan, 7.0, "b"), (3, None, 7.0, None), (4, 3.0, 7.0, "a"), (5, 8.0, 7.0, "b")]
    return spark.createDataFrame(rows, "key bigint, x double, same double, c string")


@pytest.fixture(scope="session")
def blobs(spark):
    """Three well separated classes in two dimensions, sixty rows."""
    import random

    rng = random.Random(5)
    rows = []
    for i in range(60):
        cx, cy, name = ((0, 0, "low"), (6, 0, "mid"), (0, 6, "high"))[i % 3]
        rows.append((i, cx + rng.gauss(0, 0.5), cy + rng.gauss(0, 0.5), "even" if i % 2 else "odd", name))
    return spark.createDataFrame(rows, "key bigint, x double, y double, kind string, class string").persist()
