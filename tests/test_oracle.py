"""Every registered query equals its DuckDB oracle at sf0.01 (exact values,
order-insensitive), as the driver's correctness gate checks it."""

import pytest

import __spark_entry__ as entry
from cardsentry.plans.catalog import QUERIES
from cardsentry.plans.oracle_sql import ORACLE
from conftest import SF001, SF01
from oracle_check import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(name, spark, SF01, QUERIES, ORACLE)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "fraud_reason" in df.columns


def test_expected_counts_sf0001(spark):
    """Counts agreed by two independently shaped engines (FIXTURES.md F5)."""
    q = QUERIES
    assert q["detect_above_limit"](spark, SF001).count() == 17
    assert q["above_limit_sliding_12h"](spark, SF001).count() == 35
    assert q["detect_low_values"](spark, SF001).count() == 10
    assert q["nearest_in_time"](spark, SF001).count() == 120
    assert q["detect_location_jump"](spark, SF001).count() == 23
    assert q["trailing_24h_repeat"](spark, SF001).count() == 429


@pytest.mark.parametrize("name", ["feed_positions", "trailing_24h_repeat", "nearest_in_time",
                                  "reason_text", "detect_above_limit"])
def test_results_do_not_depend_on_session_zone(spark, name):
    """The driver's session may run in any zone: batch plans use wall-clock
    (TIMESTAMP_NTZ) arithmetic only."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(name, spark, SF01, QUERIES, ORACLE)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r
