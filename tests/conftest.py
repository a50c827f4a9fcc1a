import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from rollcall.session import local_session

    session = local_session("tests", 8)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over literal rows: one(schema, rows, expr) -> list."""
    def run(schema, rows, *columns):
        frame = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
        return [tuple(r) if len(columns) > 1 else r[0] for r in frame.select(*columns).collect()]
    return run
