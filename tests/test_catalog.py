"""Every query with check SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import check_queries

FOLDER = "/root/testdata/sf0.001"
CHECKED = sorted(entry_points.oracle_sql())

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return check_queries.duck(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_its_sql(spark, con, name):
    verdict = check_queries.compare(entry_points.queries()[name](spark, FOLDER), con, entry_points.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_every_check_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
