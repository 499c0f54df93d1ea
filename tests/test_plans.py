"""Scans and exchanges of plans that could easily have more."""

import pytest
from pyspark.sql import functions as F

from shelfcast import catalog
from shelfcast.operators import daily
from shelfcast.plans import adapters

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("name, scans", [
    ("daily_usage", 1), ("prediction_vs_usage", 1), ("prediction_report", 2), ("site_usage", 3),
])
def test_scans(spark, name, scans):
    _, physical = plan(catalog.queries()[name](spark, SF))
    assert physical.count("FileScan parquet") == scans


def test_latest_census_day_reads_one_day(spark):
    _, physical = plan(catalog.queries()["census_day_long"](spark, SF))
    orders = [line for line in physical.splitlines() if "FileScan" in line and "o_custkey" in line]
    assert orders and all("GreaterThanOrEqual" in x or ">=" in x or "scalar" in x for x in orders)


def test_batches_hold_every_row(spark, tmp_path):
    """Negative keys and missing ones are in one of the two batches."""
    keys = [-3, -2, -1, 0, 1, 2, None, None]
    rows = [(k, "R", i) for i, k in enumerate(keys)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_returnflag string, day int").select(
        "l_orderkey", "l_returnflag", F.expr("timestamp'1998-01-01' + make_interval(0,0,0,day)").alias("l_shipdate")
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    total = catalog.queries()["accumulate_counts"](spark, str(tmp_path)).agg(F.sum("used")).first()[0]
    assert total == len(keys)
    parts = [catalog._batch(spark, str(tmp_path), k).agg(F.sum("used")).first()[0] for k in (0, 1)]
    assert parts == [5, 3]


def test_late_rows_show_from_their_arrival_on(spark):
    parts = spark.createDataFrame(
        [("2018-01-01", 1, 5), ("2018-01-01", 3, 2), ("2018-01-02", 2, 4)], "date string, arrival int, used long"
    )
    got = {(r.date, r.arrival): r.used for r in daily.known_as_of(parts, "arrival").collect()}
    assert got == {("2018-01-01", 1): 5, ("2018-01-01", 3): 7, ("2018-01-02", 2): 4}


def test_ward_of_an_order_needs_no_count_before_its_join(spark):
    _, physical = plan(daily.census_counts(adapters.census(spark, SF)))
    assert physical.count("HashAggregate") == 2
