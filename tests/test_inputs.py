"""Contracts of the input tables, and tables, views and DataFrames as inputs."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import deals, ledger, retention
from cohortlens.plans.catalog import INPUT_TABLES, QUERIES
from cohortlens.sources.contracts import CONTRACTS, ContractError, checked
from cohortlens.sources.tables import Tables

from .conftest import SMALL


def test_every_input_table_has_a_contract(spark):
    assert set(CONTRACTS) == set(INPUT_TABLES)
    t = Tables(spark, SMALL)
    for name in CONTRACTS:
        t.read(name)


@pytest.mark.parametrize("change,said", [
    (lambda df: df.drop("o_custkey", "o_orderdate"), ["o_custkey is missing", "o_orderdate is missing"]),
    (lambda df: df.withColumnRenamed("o_orderkey", "orderkey"), ["o_orderkey is missing"]),
    (lambda df: df.withColumn("o_orderdate", F.col("o_orderdate").cast("string")).withColumn("o_totalprice", F.lit("x")),
     ["o_orderdate is string, not a date or time", "o_totalprice is string, not a number"])])
def test_one_error_names_all_that_is_wrong(spark, change, said):
    with pytest.raises(ContractError) as error:
        Tables(spark, SMALL, bound={"orders": change(Tables(spark, SMALL).orders)}).orders
    assert all(x in str(error.value) for x in ["table orders", *said])


def test_other_widths_and_more_columns_are_fine(spark):
    df = spark.createDataFrame([(1, "x", 2)], "n_nationkey byte, n_name string, more int")
    assert checked("nation", df) is df
    with pytest.raises(ValueError, match="isn't bound"):
        Tables(spark).nation


def test_deal_fact_from_temporary_views_and_frames(spark):
    bound = {}
    for name in INPUT_TABLES:
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "orders":
            bound[name] = df
        else:
            df.createOrReplaceTempView(f"crm_{name}")
            bound[name] = f"crm_{name}"
    t = Tables(spark, bound=bound)
    got = deals.deal_fact(t, ledger.fee_ledger(t))
    want = QUERIES["d02_deal_fact"](spark, SMALL)
    key = ["id", "account_closedate_row", "opportunity_id", "first_product", "cohort_ym"]
    assert got.count() == want.count() and got.select(key).exceptAll(want.select(key)).isEmpty()
    assert retention.global_churn_v1(t).exceptAll(QUERIES["d11_global_churn_v1"](spark, SMALL)).isEmpty()
