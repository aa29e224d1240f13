import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hedonic.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8", partitions=4)


@pytest.fixture
def db(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'db'}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t)) if not order else out


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
