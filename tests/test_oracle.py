"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.01."""

import os

import pytest

import __spark_entry__ as entry
from lakeledger.plans import registry
from oracle_compare import assert_same

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = registry.queries()
ORACLES = registry.oracle_sql()

ORDERED = ["q_readmission_30d", "q_prev_event", "q_status_transitions", "q_scd2_history",
           "q_scd2_incremental", "q_scd2_as_of_join", "q_auto_cdc_scd2", "q_change_feed_since_version"]


def test_every_query_has_an_oracle():
    rows_only = set(QUERIES) - set(ORACLES)
    assert not rows_only, f"queries without oracle SQL: {sorted(rows_only)}"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    assert_same(QUERIES[name](spark, SF), ORACLES[name], SF)


@pytest.mark.parametrize("name", ORDERED)
def test_ordered_queries_match_with_hot_keys_split(spark, hot, name):
    assert_same(QUERIES[name](spark, SF), ORACLES[name], SF)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderdate", "previous_date",
                          "days_since_last", "is_readmission_30d"]
    assert df.count() > 0
