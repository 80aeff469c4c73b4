"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest
from check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from candlelake.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) == ""


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:2] == ["coin_id", "source_updated_at"]
    assert df.count() > 0
