import csv
import tempfile
from pathlib import Path

import pyarrow.parquet as pq

from pyspark.sql import functions as F

from cohortlens.sources import sinks


def test_export_by_dim_roundtrip(spark):
    df = spark.createDataFrame([("2020-01-01", "a", 1.9), ("2020-01-01", "a", 1.2), ("2021-01-01", "b", -0.5)],
                               "activity_date string, cls string, v double")
    path = tempfile.mkdtemp(prefix="cohortlens-sink-") + "/out"
    out = sinks.export_by_dim(df, "activity_date", "cls", "v", "value", path)
    back = spark.read.option("header", True).csv(path).select("activity_date", "cls", F.col("value").cast("long"))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, back.collect())) == [
        ("2020-01-01", "a", 3), ("2021-01-01", "b", 0)]


def test_report_titles(spark):
    from cohortlens.operators.retention import with_report_titles
    df = spark.createDataFrame([("2020-01-01", "QP", 1)], "closed_month string, first_product_category string, "
                                                          "new_accounts int")
    assert with_report_titles(df).columns == ["CLOSED MONTH", "FIRST_PRODUCT_CATEGORY", "NEW ACCOUNTS"]


def _rows(spark):
    return spark.range(5000).select(((F.col("id") * 7919) % 613).alias("k"), F.col("id").alias("v"), F.when(F.col("id") % 5 != 0, F.lit('a "b", c')).alias("t"))


def test_order_survives_the_write(spark):
    path = tempfile.mkdtemp(prefix="cohortlens-sink-") + "/sorted"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, small as they are
    try:
        sinks.write_sorted(_rows(spark), path, ["k", "v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(Path(path).glob("part-*.parquet"))
    got = [(r["k"], r["v"]) for f in files for r in pq.read_table(f).to_pylist()]
    assert len(files) > 1 and got == sorted(got) and len(got) == 5000


def test_rows_are_numbered_in_order(spark):
    got = sinks.numbered(_rows(spark), ["k", "v"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(5000)) and [(r.k, r.v) for r in got] == sorted((r.k, r.v) for r in got)


def test_one_ordered_file_with_an_index(spark):
    path = tempfile.mkdtemp(prefix="cohortlens-sink-") + "/one.csv"
    for _ in range(2):  # a second export replaces the first
        sinks.export_csv(_rows(spark), path, ["k", "v"], index="idx")
    with open(path, newline="") as f:
        lines = list(csv.reader(f, escapechar="\\", doublequote=False))
    assert lines[0] == ["idx", "k", "v", "t"] and [int(x[0]) for x in lines[1:]] == list(range(5000))
    assert [(int(x[1]), int(x[2])) for x in lines[1:]] == sorted((int(x[1]), int(x[2])) for x in lines[1:])
    assert {x[3] for x in lines[1:]} == {"", 'a "b", c'}
    assert not list(Path(path).parent.glob("*.parts")) and not list(Path(path).parent.glob("*.unfinished"))
    sinks.export_csv(_rows(spark).where("false"), path, ["k"])
    assert Path(path).read_text() == "k,v,t\n"


def test_sampled_accounts_read_back_in_order(spark):
    from cohortlens.operators import sampling
    from cohortlens.plans.catalog import Layers

    from .conftest import SMALL

    path = tempfile.mkdtemp(prefix="cohortlens-sink-") + "/d23"
    sinks.write_sorted(sampling.sample_accounts(Layers(spark, SMALL).base), path, ["accountid", "account_closedate_row"])
    got = [(r["accountid"], r["account_closedate_row"]) for f in sorted(Path(path).glob("part-*")) for r in pq.read_table(f).to_pylist()]
    assert got and got == sorted(got)


def test_draws_with_replacement_repeat_accounts(spark):
    from cohortlens.operators import sampling

    base = spark.range(30).select(F.col("id").alias("accountid"), F.lit("TRADING ONLY").alias("first_product_category"))
    draws = {r.accountid: r.draws for r in sampling.drawn_accounts(base, k=60).collect()}
    assert sum(draws.values()) == 60 and max(draws.values()) > 1 and set(draws) <= set(range(30))
    assert sampling.sample_accounts_with_replacement(base.where("false")).collect() == []
