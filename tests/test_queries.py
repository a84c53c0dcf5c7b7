"""Every registered query against its SQL in DuckDB, and the shape of plans."""

import re

import pytest

import __spark_entry__ as entry
from suite import queries as Q
from suite.check import differences, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = Q.QUERIES, Q.ORACLES
@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["co_autocorr", "co_autocorr_by_type", "dn_quantile", "en_sampen", "en_apen",
                                  "sb_binarystats", "ex_movingthreshold", "table_normalise"])
def test_no_cross_join_without_broadcast(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Broadcast" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = QUERIES["co_autocorr"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", plan))) <= {
        "ts,user_id,value", "ts,user_id"}


def test_raw_rows_are_ordered_in_one_shuffle(spark):
    """All look-ahead and aggregation of an ordered operator shares the one exchange by window."""
    plan = QUERIES["co_autocorr"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    plan = re.sub(r"#\d+L?", "", plan)
    assert plan.count("Exchange hashpartitioning(series, w") == 1
