import os
from pathlib import Path

import compare
import pytest

import __spark_entry__ as entry
from catalogue.base import ORACLE, QUERIES

SF = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
# Results that are rightly empty on the smallest tables.
MAY_BE_EMPTY = {"so3_common_days", "au2_common_days"}

needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    message = compare.difference(spark, con, name, QUERIES[name], ORACLE[name], SF)
    if message == "EMPTY" and name in MAY_BE_EMPTY:
        return
    assert message in (None, "EMPTY"), message


@needs_data
def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0 and "brier_score" in frame.columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
