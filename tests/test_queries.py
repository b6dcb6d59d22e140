"""Every registered query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import database, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


# regions with more than so many buildings, or orbits with so many scenes, do not occur in the smallest tables
MAY_BE_EMPTY = {"top_large_regions", "on_common_orbits", "orbit_counts", "qualifying_orbits_per_tile", "select_s1", "regions_above"}


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    problem = differences(spark, db, SF, name)
    if name in MAY_BE_EMPTY and problem == "no rows on either side":
        return
    assert problem is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
