import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plaintlens.session import build_session, clear_scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(os.environ.get("TEST_CPUS", "8"), app="tests")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Evaluate a column function on a list of texts, in order."""
    from pyspark.sql import functions as F

    def run(fn, texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, t string")
        got = dict(df.select("i", fn(F.col("t"))).collect())
        return [got[i] for i in range(len(texts))]

    return run
