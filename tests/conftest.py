import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from syncspark.session import local_session  # noqa: E402


# Column expressions at module level need a running session.
SESSION = local_session(
    cores="8", memory="6g", app="tests", extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="syncspark-tests-"), "spark.sql.shuffle.partitions": "4"}
)


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def values(spark):
    """Evaluate one expression over a list of values of a type."""

    def run(items, expression, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
        rows = df.select("i", expression.alias("r")).collect()
        return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]

    return run
