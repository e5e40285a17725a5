import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitwall.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def rows():
    """Sorted plain tuples of a DataFrame."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


@pytest.fixture
def new_warehouse(spark, tmp_path):
    """Warehouses with databases of their own, which go at the end."""
    from pitwall.sources.warehouse import Warehouse

    made = []

    def make(name="warehouse"):
        made.append(Warehouse(spark, str(tmp_path / name), f"t{uuid.uuid4().hex[:12]}"))
        return made[-1]

    yield make
    for one in made:
        for layer in ("raw", "staging", "marts"):
            spark.sql(f"DROP DATABASE IF EXISTS `{one.database(layer)}` CASCADE")


@pytest.fixture
def warehouse(new_warehouse):
    return new_warehouse()
