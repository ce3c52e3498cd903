"""
order, no deal qualification) reproduces the sums recorded there."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cube, intervals

SF001 = "/root/testdata/sf0.01"

EXPECTED = {
    6: {"retained": 68199, "churned": 5344, "new": 1500,
        "yearly_retained": [1174, 1361, 1328, 1336, 1357, 1342, 1208],
        "yearly_churned": [0, 68, 137, 113, 110, 124, 232],
        "yearly_new": [1174, 255, 51, 11, 5, 1, 3]},
    12: {"retained": 91403, "churned": 2293, "new": 1500,
         "yearly_retained": [1174, 1429, 1419, 1412, 1429, 1420, 1365],
         "yearly_churned": [0, 0, 61, 65, 52, 59, 106],
         "yearly_new": [1174, 255, 51, 11, 5, 1, 3]},
}


@pytest.fixture(scope="module")
def raw(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    zero = F.lit(0).cast("decimal(26,6)")
    return o.select(F.col("o_custkey").alias("accountid"), F.to_date("o_orderdate").alias("activity_date"),
                    F.lit("all").alias("seg"), zero.alias("gmv"), zero.alias("revenue"))


@pytest.mark.parametrize("n", [6, 12])
def test_monthly_and_yearly_sums(raw, n):
    exp = EXPECTED[n]
    m = cube.kpi_cube(raw, n=n, grain="month", dims=["seg"]).agg(
        F.sum("retained_accounts"), F.sum("churned_accounts"), F.sum("new_accounts")).collect()[0]
    assert tuple(m) == (exp["retained"], exp["churned"], exp["new"])
    y = cube.kpi_cube(raw, n=n, grain="year", dims=["seg"]).orderBy("activity_date").collect()
    assert [r.retained_accounts for r in y] == exp["yearly_retained"]
    assert [r.churned_accounts for r in y] == exp["yearly_churned"]
    assert [r.new_accounts for r in y] == exp["yearly_new"]


def test_return_intervals(raw):
    r = intervals.return_interval_stats(raw).collect()[0]
    assert r.intervals == 13468
    assert round(r.mean_days, 4) == 214.0013
    assert r.median_days == 151
