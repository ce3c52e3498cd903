"""The awkward deals and fees of FIXTURES.md section 4, and values far outside
those of the supplied tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.columns import product_category, trunc_toward_zero
from cohortlens.operators import cube, deals, ledger, retention
from cohortlens.sources import sinks

from .conftest import SMALL


def windows(df, **more):
    return deals.account_windows(df, "acct", "day", ["id"], firsts={"first_product": "label"}, lasts={"last_product": "label"},
                                 maxes={}, sums={}, row_number="rn", **more)


def test_tie_on_a_date_is_decided_by_the_deal(spark):
    day = dt.date(2020, 1, 5)
    df = spark.createDataFrame([(1, 12, day, "QP50"), (1, 11, day, "PCP"), (1, 13, day, "QP80")], "acct long, id long, day date, label string")
    assert {(r.id, r.rn, r.first_product, r.last_product) for r in windows(df).collect()} == {
        (11, 1, "PCP", "QP80"), (12, 2, "PCP", "QP80"), (13, 3, "PCP", "QP80")}


def test_fee_group_without_descriptions(spark):
    fees = spark.createDataFrame([(1, "Shipment", "AdminFee", Decimal("2.5"), None), (1, "Shipment", "AdminFee", Decimal("1.5"), None),
                                  (2, "Shipment", "Other", Decimal("1"), "x"), (3, "Invoice", "AdminFee", Decimal("1"), "x")],
                                 "feeable_id long, feeable_type string, type string, amount decimal(18,2), description string")
    assert [(r.feeable_id, r.admin_fee, r.application_fees, r.description) for r in ledger.fee_pivot(fees).collect()] == [(1, Decimal("4.00"), None, "")]


@pytest.mark.parametrize("rate,want", [("-0.12345", "-0.1234"), ("0.12349", "0.1234"), ("-0.00009", "0.0000"), ("7", "7.0000")])
def test_rates_are_cut_towards_zero(spark, rate, want):
    df = spark.createDataFrame([(Decimal(rate),)], "v decimal(18,6)")
    assert df.select(trunc_toward_zero(F.col("v"), 4)).first()[0] == Decimal(want)


def test_labels_outside_all_lists(spark):
    df = spark.createDataFrame([("QP50",), ("PCP",), ("qp50",), (None,), ("Trading only",), ("PreSeason",), ("new thing",)], "l string")
    got = df.select(product_category("l", 1), product_category("l", 2)).collect()
    assert [tuple(r) for r in got] == [("QP", "QP"), ("OTHER", "QP"), ("OTHER", "OTHER"), ("OTHER", "OTHER"), ("TRADING ONLY", "TRADING ONLY"),
                                       ("PRESEASON", "PRESEASON"), ("OTHER", "OTHER")]


def test_which_deals_qualify(spark):
    rows = [(1, False, True, True, "InSeason", "Closed Won"), (2, True, True, True, "InSeason", "Closed Won"),
            (3, False, False, False, "Marketplace shipments", "In Transit"), (4, False, False, False, "Marketplace Shipments", "Rejected"),
            (5, False, False, False, "MARKETPLACE SHIPMENTS", "Canceled"), (6, False, True, False, "InSeason", "Closed Lost")]
    df = spark.createDataFrame(rows, "id long, isdeleted boolean, isclosed boolean, iswon boolean, record_type_name__c string, stagename string")
    assert {r.id for r in deals.qualified(df).collect()} == {1, 3}


class Few:
    """A few orders and lines in the place of the supplied tables."""

    def __init__(self, spark, orders, price):
        from cohortlens.sources.tables import Tables

        self._t = Tables(spark, SMALL)
        line = self._t.lineitem.limit(1)
        self.orders = spark.createDataFrame(
            [(k, 1, "F", float(price), dt.datetime(*d), "2-HIGH") for k, d in orders],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
        self.lineitem = (self.orders.crossJoin(line.drop("l_orderkey", "l_extendedprice"))
                         .select(F.col("o_orderkey").alias("l_orderkey"), F.lit(float(price)).alias("l_extendedprice"),
                                 *[c for c in line.columns if c not in ("l_orderkey", "l_extendedprice")]))

    def __getattr__(self, name):
        return getattr(self._t, name)


def test_deals_outside_the_supplied_years_and_large_amounts(spark):
    t = Few(spark, [(1, (1960, 3, 5)), (2, (2050, 7, 1)), (3, (2050, 8, 2))], 1e13)
    fees = ledger.fee_ledger(t)
    assert max(r.total_gmv for r in fees.where("source = 'TMS'").collect()) >= Decimal(3 * 10**13)
    base = deals.deal_fact(t, fees)
    assert {r.activity_date.year for r in base.collect()} == {1960, 2050}
    scaffold = retention.dim_scaffold(base)
    months = scaffold.agg(F.min("month_idx"), F.max("month_idx"), F.count_distinct("month_idx")).first()
    assert tuple(months) == (dt.date(1960, 3, 1), dt.date(2050, 8, 1), 90 * 12 + 6)
    report = retention.churn_report(retention.account_months(base), scaffold)
    assert report.agg(F.sum("new_accounts"), F.sum("churned_accounts")).first()[:] == (1, 1)
    v1 = retention.global_churn_v1(t)
    assert v1.agg(F.sum("new_accounts"), F.sum("churned_accounts")).first()[:] == (1, 1)
    assert len(cube.kpi_cube(base, n=6, grain="year").collect()) == 91


def test_repeated_slug_repeats_the_deal(spark):
    t = Few(spark, [(2, (1999, 1, 1))], 100)
    one = ledger.fee_ledger(t)
    two = one.unionByName(one.withColumn("name", F.concat("name", F.lit(" again"))))
    assert deals.deal_fact(t, two).count() == 2 * deals.deal_fact(t, one).count()


def test_preseason_without_funding_date(spark):
    t = Few(spark, [(89, (1999, 1, 1)), (90, (1999, 1, 1))], 100)
    t.orders = t.orders.withColumn("o_orderpriority", F.lit("1-URGENT"))
    got = {r.opportunity_id: r.activity_date for r in deals.deal_fact(t, ledger.fee_ledger(t)).collect()}
    assert got == {89: None, 90: dt.date(1999, 1, 31)}


def test_notes_of_a_repeated_item_are_told_once(spark):
    items = spark.createDataFrame([(5, 50), (5, 50), (6, 60)], "id long, shipment_id long")
    notes = spark.createDataFrame([(1, 5, "Shipment", "a"), (2, 5, "Shipment", "b"), (3, 50, "FactoringRequest", "c"), (4, 7, "Shipment", "d")],
                                  "note_id long, noteable_id long, noteable_type string, body string")
    assert {(r.id, r.self_note_body) for r in ledger.notes_rollup(notes, items).where("noteable_type LIKE 'Ship%'").collect()} == {(50, "a, b, c")}


def test_table_and_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    sinks.create_or_replace_table(df, "cohortlens_test_table")
    sinks.create_or_replace_table(df.where("k = 2"), "cohortlens_test_table")
    assert [tuple(r) for r in spark.table("cohortlens_test_table").collect()] == [(2, "b")]
    spark.sql("DROP TABLE cohortlens_test_table")
    from cohortlens.plans.catalog import QUERIES

    for name in ("d16_yearly_retained_by_dim", "d18_cohort_table", "d13b_products_per_closed_year"):
        rows = QUERIES[name](spark, SMALL)
        sinks.write_csv(rows, str(tmp_path / name))
        back = spark.read.option("header", True).csv(str(tmp_path / name))
        assert back.columns == rows.columns and back.count() == rows.count()
