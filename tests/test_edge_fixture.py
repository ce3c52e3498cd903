"""Hand-made five-account fixture (FIXTURES.md section 4), window n=6.

Months are relative to M0 = 2020-01; the last observed month is M20.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import cube, retention

M0 = dt.date(2020, 1, 1)


def month(i: int) -> dt.date:
    y, m = divmod(M0.month - 1 + i, 12)
    return dt.date(M0.year + y, m + 1, 1)


ACTIVE = {"a1": [0], "a2": [0, 7], "a3": [0, 8], "a4": [18], "a6": [20]}


@pytest.fixture(scope="module")
def base(spark):
    rows = []
    for acct, months in ACTIVE.items():
        for m in months:
            rows.append((acct, month(m) + dt.timedelta(days=3), 10))
    rows.append(("a5", None, 5))                  # null date only
    rows.append(("a1", month(0) + dt.timedelta(days=9), 1))   # same month, second deal
    df = spark.createDataFrame(rows, "accountid string, activity_date date, v int")
    return df.select(
        "accountid", "activity_date",
        F.col("v").cast("decimal(26,6)").alias("gmv"), F.col("v").cast("decimal(26,6)").alias("revenue"),
        F.lit("Whale").alias("account_class"), F.lit("QP").alias("first_product_category"),
        F.when(F.col("activity_date").isNotNull(), F.lit(M0)).cast("date").alias("cohort_ym"),
        F.lit("X").alias("country"))


def _flags(base, spark):
    """Months in which each account by itself is retained, churned and new."""
    out = {}
    for account in ("a1", "a2", "a3", "a4", "a5"):
        one = base.where((base.accountid == account) | (base.accountid == "a6"))
        both = cube.kpi_cube(one, n=6, grain="month").collect()
        other = {r.activity_date: r for r in cube.kpi_cube(base.where(base.accountid == "a6"), n=6, grain="month").collect()}
        out[account] = {k: set() for k in ("r", "c", "nw")}
        for r in both:
            o = other.get(r.activity_date)
            for k, c in (("r", "retained_accounts"), ("c", "churned_accounts"), ("nw", "new_accounts")):
                if r[c] - (o[c] if o else 0):
                    out[account][k].add(r.activity_date)
    return out


def test_retained_churned_new(base, spark):
    f = _flags(base, spark)
    rng = lambda a, b: {month(i) for i in range(a, b + 1)}
    assert f["a1"]["r"] == rng(0, 6) and f["a1"]["c"] == {month(7)} and f["a1"]["nw"] == {month(0)}
    assert f["a2"]["r"] == rng(0, 13) and f["a2"]["c"] == {month(14)}
    assert f["a3"]["r"] == rng(0, 6) | rng(8, 14) and f["a3"]["c"] == {month(7), month(15)}
    assert f["a4"]["r"] == rng(18, 20) and f["a4"]["c"] == set()
    assert not any(f["a5"].values())


def test_dense_cube_counts(base, spark):
    c = cube.kpi_cube(base, n=6, grain="month").orderBy("activity_date").collect()
    assert len(c) == 21                                        # M0..M20, one segment
    by = {r.activity_date: r for r in c}
    assert by[month(0)].new_accounts == 3                      # a1, a2, a3
    assert by[month(7)].churned_accounts == 2                  # a1 and a3 (window 0..6 ended)
    assert by[month(7)].retained_accounts == 1                 # a2, active again at M7
    assert sum(r.churned_accounts for r in c) == 4             # a1@7, a2@14, a3@7, a3@15
    # lifetime money once per retained account: a1 = 11, a2 = a3 = 20
    assert by[month(3)].retained_gmv == 11 + 20 + 20
    assert by[month(20)].retained_accounts == 2                # a4 (18..20) and a6 (20)


def test_sql_path_agrees_with_cube(base, spark):
    """Band-join semantics (D8/D9 via explode/lead) agree with the cube's counts."""
    mg = (base.where(F.col("activity_date").isNotNull())
          .groupBy(F.col("accountid").alias("account_id"), F.trunc("activity_date", "MM").alias("closed_month"),
                   *cube.CUBE_DIMS)
          .agg(F.sum("revenue").alias("revenue"), F.sum("gmv").alias("gmv"),
               F.lit(1).alias("min_account_closedate_row"))
          .withColumn("ret_date_max", F.add_months("closed_month", 6))
          .withColumn("churn_date", F.add_months("closed_month", 7)))
    months = spark.createDataFrame([(month(i),) for i in range(21)], "month_idx date")
    scaffold = mg.select(*cube.CUBE_DIMS).distinct().crossJoin(months)
    ret = {r.month_idx: r.retained_accounts for r in retention.retained(
        mg, scaffold, start=month(0), as_of=month(20)).collect()}
    ch = {r.month_idx: r.churned_accounts for r in retention.churned(mg, scaffold).collect()}
    cb = {r.activity_date: r for r in cube.kpi_cube(base, n=6, grain="month").collect()}
    for m in ret:
        assert ret[m] == cb[m].retained_accounts
        assert ch[m] == cb[m].churned_accounts
