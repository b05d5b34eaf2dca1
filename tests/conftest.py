import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meritrix.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame: ``rows("a int, b string", (1, "x"), ...)``."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def one(spark):
    """Evaluate a Column over one row given as SQL literals."""

    def evaluate(column_of, **literals):
        sql = ", ".join(f"{v} AS {k}" for k, v in literals.items()) or "1 AS x"
        return spark.sql(f"SELECT {sql}").select(column_of.alias("r")).first().r

    return evaluate
