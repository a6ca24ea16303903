"""Every registered query against its SQL twin on the small tables."""

import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    from compare import connect

    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    from compare import difference

    assert difference(spark, db, FOLDER, name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
