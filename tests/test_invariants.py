
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import cube, deals, intervals, ledger
from cohortlens.plans.catalog import Layers
from cohortlens.sources.tables import Tables

from .conftest import SMALL


def test_partition_invariance_and_density(spark):
    """Yearly totals agree over every single-dimension roll-up; every observed
    value has every year."""
    df = cube.yearly_retained_by_dim(Layers(spark, SMALL).base, n=6).toPandas()
    totals = df.groupby(["dim_name", "activity_date"]).retained_accounts.sum().unstack(0)
    assert (totals.nunique(axis=1) == 1).all()
    per_value = df.groupby(["dim_name", "dim_value"]).activity_date.nunique()
    assert per_value.nunique() == 1


def test_label_rollup_counts_each_label(spark):
    base = Layers(spark, SMALL).base
    by_first = cube.yearly_retained_by(base, ["first_product_category"], n=6).groupBy("activity_date") \
        .agg(F.sum("retained_accounts").alias("a")).toPandas().set_index("activity_date").a
    by_label = cube.yearly_retained_by_label(base, n=6).groupBy("activity_date") \
        .agg(F.sum("retained_accounts").alias("b")).toPandas().set_index("activity_date").b
    assert (by_label.reindex(by_first.index).fillna(0) >= by_first).all()


import pytest


@pytest.mark.parametrize("range_rows", [40, 700, deals.RANGE_ROWS])
@pytest.mark.parametrize("ids", ["numbers", "sparse", "same_prefix", "nulls"])
def test_account_windows_match_plain_windows(spark, ids, range_rows):
    """Ranges equal one window over each account, including a hot account holding
    most rows, whatever its ids look like."""
    rows = [(1 if i % 10 else 2 + i % 3, i, (i * 7919) % 50 if i % 13 else None, f"p{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "acct long, id long, d int, label string") \
        .withColumn("day", F.expr("date_add(date'2020-01-01', d)"))
    number = F.col("id")
    df = df.withColumn("id", {
        "numbers": number, "sparse": number * 10**12, "same_prefix": F.concat(F.lit("a long common prefix "), F.lpad(number.cast("string"), 5, "0")),
        "nulls": F.when(number != 77, number)}[ids])
    got = deals.account_windows(df, "acct", "day", ["id"], firsts={"fl": "label", "fd": "day"},
                                lasts={"ll": "label"}, maxes={"mx": F.col("d")}, sums={"sd": "d"}, row_number="rn", range_rows=range_rows)
    w = Window.partitionBy("acct").orderBy(F.col("day").asc_nulls_last(), F.col("id").asc_nulls_first())
    wf = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = df.select("acct", "id", F.row_number().over(w).alias("rn"), F.first("label").over(wf).alias("fl"),
                     F.first("day").over(wf).alias("fd"), F.last("label").over(wf).alias("ll"),
                     F.max("d").over(Window.partitionBy("acct")).alias("mx"),
                     F.sum("d").over(Window.partitionBy("acct")).alias("sd"))
    cols = ["acct", "id", "rn", "fl", "fd", "ll", "mx", "sd"]
    a = got.select(*cols).toPandas().sort_values(["acct", "id"]).reset_index(drop=True)
    b = want.select(*cols).toPandas().sort_values(["acct", "id"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_return_intervals_brute_force(spark):
    base = Layers(spark, SMALL).base
    pdf = base.select("accountid", "activity_date").toPandas().sort_values(["accountid", "activity_date"])
    pdf["activity_date"] = pd.to_datetime(pdf["activity_date"])
    prev = pdf.groupby("accountid").activity_date.shift(1)
    ri = (pdf.activity_date - prev).dt.days.dropna()
    ri = ri[ri > 0]
    got = intervals.return_interval_stats(base).collect()[0]
    assert got.intervals == len(ri)
    assert abs(got.mean_days - ri.mean()) < 1e-9
    assert got.median_days == ri.median()
    hist = intervals.return_interval_histogram(base).orderBy("bin").toPandas()
    import numpy as np
    counts, _ = np.histogram(ri.values, bins=30)
    assert hist.frequency.tolist() == counts.tolist()


def test_ledger_layout(spark):
    t = Tables(spark, SMALL)
    df = ledger.fee_ledger(t)
    assert df.columns == ledger.LEDGER_COLUMNS and len(df.columns) == 72
    assert df.count() == df.distinct().count()


def test_cube_per_activity_money_equals_sql_report(spark):
    """SURVEY 3.4: the cube's SQL money rule equals the band-join report
    on every month both cover."""
    from cohortlens.operators import retention
    L = Layers(spark, SMALL)
    dims = list(retention.REPORT_DIMS)
    c = cube.kpi_cube(L.base, n=12, money_mode="per_activity").select(
        F.col("activity_date").alias("month_idx"), *dims, "retained_accounts", "retained_rev")
    r = retention.retained(L.mg(12), L.scaffold).select("month_idx", *dims, "retained_accounts",
                                                        F.col("revenue").alias("rev"))
    j = c.join(r, ["month_idx", *dims]).toPandas()
    assert len(j) > 0
    assert (j.iloc[:, len(dims) + 1] == j.iloc[:, len(dims) + 3]).all()     # account counts
    assert ((j.retained_rev.astype(float) - j.rev.fillna(0).astype(float)).abs() < 1e-6).all()


def test_notes_of_a_hot_owner_are_put_together_from_ranges(spark):
    """Every range gives one string; no group of rows is a whole hot owner."""
    from cohortlens.operators import ranges

    notes = spark.range(3000).select(
        ((F.col("id") * 7919) % 3000).alias("note_id"), F.when(F.col("id") % 3 == 0, F.col("id") % 50 + 2).otherwise(1).alias("noteable_id"),
        F.lit("FactoringRequest").alias("noteable_type"), F.when(F.col("id") % 11 != 0, F.concat(F.lit("n"), F.col("id"))).alias("body"))
    items = spark.createDataFrame([], "id long, shipment_id long")
    plain = {r.id: r for r in ledger.notes_rollup(notes, items).collect()}
    split = {r.id: r for r in ledger.notes_rollup(notes, items, range_rows=100).collect()}
    assert split == plain and len(plain) == 51
    want = notes.where("noteable_id = 1").orderBy("note_id").collect()
    assert plain[1].self_note_body == ", ".join(r.body for r in want if r.body is not None)
    keys = notes.select(F.col("noteable_id").alias("_of"), F.struct("note_id").alias(ranges.ORDER))
    sizes = ranges.with_range(keys, "_of", ranges.range_bounds(keys, 100)).groupBy("_of", ranges.RANGE).count()
    assert sizes.agg(F.max("count")).first()[0] < 300 < 2000


def test_obligation_totals_equal_their_parts(spark):
    from cohortlens.sources import adapters as A

    t = Tables(spark, SMALL)
    got = {r.id: r for r in ledger.obligation_totals(A.obligation_lines(t)).collect()}
    for r in ledger.fee_pivot(A.fees(t)).collect():
        k = {"Shipment": "s", "FactoringRequest": "f"}[r.feeable_type]
        o = got[r.feeable_id]
        assert (o[f"ob_{k}_admin_fee"], o[f"ob_{k}_application_fees"], o[f"ob_{k}_description"]) == (r.admin_fee, r.application_fees, r.description)
    owners = {(r.feeable_id, r.feeable_type) for r in ledger.fee_pivot(A.fees(t)).collect()}
    assert all(((i, "Shipment") in owners) == (o.ob_s_description is not None) for i, o in got.items())
    parts = [(ledger.shipment_totals(A.shipment_items(t)), "shipment_id", {"accepted_shipment": "ob_accepted_shipment", "total_gmv": "ob_total_gmv"}),
             (ledger.additional_fee_totals(A.additional_shipment_fees(t)), "shipment_id", {"add_fee": "ob_add_fee"}),
             (ledger.factoring_payments(A.factoring_request_payments(t)), "factoring_request_id", {"pay": "ob_pay"}),
             (ledger.factoring_balance(A.asset_balance_transfers(t)), "to_id", {"bal": "ob_bal"})]
    for df, key, columns in parts:
        rows = {r[key]: r for r in df.collect()}
        for i, o in got.items():
            assert all(o[c] == (rows[i][p] if i in rows else None) for p, c in columns.items())


def test_difference_events_do_not_depend_on_the_window(spark):
    """Two events an account-month, whatever n is; the same report as the months spelt out."""
    from cohortlens.operators import retention

    L = Layers(spark, SMALL)
    for n in (0, 3, 30):
        mg = retention.account_months(L.base, n)
        dims = list(retention.REPORT_DIMS)
        got = retention.retained(mg, L.scaffold).select("month_idx", *dims, "retained_accounts", "revenue", "gmv")
        months = mg.where("closed_month IS NOT NULL").withColumn("month_idx", F.explode(F.sequence("closed_month", "ret_date_max", F.expr("interval 1 month"))))
        per = months.groupBy("month_idx", *dims).agg(F.count_distinct("account_id").alias("retained_accounts"), F.sum("revenue").alias("revenue"), F.sum("gmv").alias("gmv"))
        want = L.scaffold.select("month_idx", *dims).join(per, ["month_idx", *dims], "left").withColumn("retained_accounts", F.coalesce("retained_accounts", F.lit(0)))
        numbers = lambda df: df.select("month_idx", *dims, *[F.col(c).cast("double") for c in ("retained_accounts", "revenue", "gmv")])
        assert numbers(got).exceptAll(numbers(want)).isEmpty() and got.count() == want.count()


def test_the_deals_are_joined_once(spark):
    """What the windows and the result read is stored: no input is read for the wide
    rows again."""
    t = Tables(spark, SMALL)
    stored = ledger.fee_ledger(t).withColumn("total_late_fees", F.when(F.col("total_late_fees") != 0, F.col("total_late_fees")))
    for df in (deals.deal_fact(t, stored), deals.deal_fact(t, stored, loan_tape=True), deals.deal_fact_v1(t, stored)):
        assert df.count() > 0 and not any(SMALL in f for f in df.inputFiles())


def test_the_ledger_columns_are_never_shuffled(spark):
    """The 72 columns are written out of what determines them, after every join and
    after equal rows have been removed."""
    import re

    df = ledger.fee_ledger(Tables(spark, SMALL))
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    widths = [int(n) for n in re.findall(r"\) Exchange\s*\nInput \[(\d+)\]", plan)]
    assert widths and max(widths) < 24


def test_rows_that_come_twice_are_in_the_ledger_once(spark):
    t, twice = Tables(spark, SMALL), Tables(spark, SMALL)
    for name in ("orders", "customer", "supplier", "part"):
        rows = getattr(t, name)
        setattr(twice, name, rows.unionByName(rows))
    # an order told again with another hour and another buyer of the same name is the same order
    again = twice.orders.withColumns({"o_custkey": F.lit(-1).cast("long"), "o_orderdate": F.col("o_orderdate") + F.expr("interval 1 hour")})
    buyer = t.customer.limit(1)
    t.orders = t.orders.withColumn("o_custkey", F.lit(buyer.first().c_custkey).cast("long"))
    twice.orders = t.orders.unionByName(again)
    twice.customer = twice.customer.unionByName(buyer.withColumn("c_custkey", F.lit(-1).cast("long")))
    a, b = (ledger.fee_ledger(x).drop("seller_marketplace_fee_percentage", "buyer_marketplace_fee_percentage") for x in (t, twice))
    assert a.count() > 0 and a.exceptAll(b.distinct()).isEmpty() and b.distinct().exceptAll(a).isEmpty()
    assert (ledger.fee_ledger(twice).groupBy(*ledger.LEDGER_COLUMNS).count().where("count > 1").isEmpty())


@pytest.mark.parametrize("range_rows", [40, 700, deals.RANGE_ROWS])
def test_accounts_are_joined_where_the_windows_run(spark, range_rows):
    """The same as a join before plain windows: accounts that are missing, NULL or told twice,
    a hot one among them, and first and last values that only the account has."""
    rows = [(None if i % 97 == 0 else 1 if i % 10 else 2 + i % 4, i // 2, (i * 7919) % 50 if i % 13 else None, i * 0.5) for i in range(3000)]
    df = spark.createDataFrame(rows, "acct long, id long, d int, v double").select(
        "acct", "id", F.expr("date_add(date'2020-01-01', d)").alias("day"), "d", F.col("v").cast("decimal(26,6)").alias("v"))
    accounts = spark.createDataFrame([(1, "a"), (1, "z"), (2, "b"), (3, None), (4, "d"), (4, "d"), (None, "n")], "acct long, class string")
    args = dict(firsts={"fc": "class"}, lasts={"lc": "class"}, maxes={"mx": F.col("d")}, sums={"sv": "v"}, row_number="rn", range_rows=range_rows)
    apart = deals.account_windows(df, "acct", "day", ["id"], accounts=accounts, **args)
    first = deals.account_windows(df.join(accounts, "acct"), "acct", "day", ["id"], **{**args, "range_rows": deals.RANGE_ROWS})
    assert dict(apart.dtypes) == dict(first.dtypes)
    # rows that agree in the whole order are numbered in any order
    numbers = lambda x: x.groupBy("acct").agg(F.sort_array(F.collect_list("rn")).alias("rn"))
    assert numbers(apart).exceptAll(numbers(first)).isEmpty() and apart.count() == first.count() > 3000
    columns = ["acct", "id", "day", "class", "fc", "lc", "mx", "sv"]
    assert apart.select(*columns).exceptAll(first.select(*columns)).isEmpty()
    least = apart.groupBy("acct", "day", "id").agg(F.min("rn").alias("rn"))
    assert least.exceptAll(first.groupBy("acct", "day", "id").agg(F.min("rn").alias("rn"))).isEmpty()


def _exchanges(spark, df):
    """Columns of each shuffle of the plan, without those that only deal out a sort."""
    import re

    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [int(n) for n in re.findall(r"\) Exchange\s*\nInput \[(\d+)\]", plan)]


def test_ledger_rows_do_not_move_again_for_their_invoices(spark):
    """Nothing is joined to the lines of an order but where these rows lie already."""
    from cohortlens.sources import adapters as A

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, SMALL)
        orders = ledger.obligations(t)
        sales = ledger.sale_opportunities(A.opportunities(t).repartition("slug__c")).select(F.col("slug").alias("sop_slug"), "product_type").distinct()
        # the widest is that of an obligation's totals; they would move with the rest of the row else
        assert max(_exchanges(spark, ledger._factoring_arm(t, orders, sales))) < 13
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_cube_moves_its_months_once(spark):
    """Totals and months of an account come from one aggregation, whose rows the windows take."""
    base = spark.createDataFrame([(1, "A", "1", i % 7, 1.0) for i in range(50)] + [(1, "B", None, 1, 1.0), (2, "A", "1", None, 2.0)],
                                 "k long, a string, b string, m int, v double").select(
        "k", "a", "b", F.expr("add_months(date'2020-01-15', m)").alias("day"), F.col("v").cast("decimal(26,6)").alias("gmv"), F.lit(None).cast("decimal(26,6)").alias("revenue"))
    act = cube.activity(base, "k", ["a", "b"], "day")
    assert len(_exchanges(spark, act)) == 1
    assert len(_exchanges(spark, cube.monthly_events(act, "k", ["a", "b"], 3))) == 2
    got = {(r.k, r.month.month, float(r.gmv_total), float(r.rev_total)) for r in act.collect()}
    assert got == {(1, m, 50.0, 0.0) for m in range(1, 8)} and act.count() == 7


def test_a_tape_row_stays_with_its_deal(spark):
    """By slug, each deal has its own rows of the tape once, also where its order is told twice."""
    t = Tables(spark, SMALL)
    once = deals._tapes_by_slug(t, deals.A.opportunities(t))
    t2 = Tables(spark, SMALL)
    t2.orders = t2.orders.unionByName(t2.orders)
    key = lambda df: {(r._tapes_of, frozenset(r._tapes)) for r in df.collect()}
    assert key(once) == key(deals._tapes_by_slug(t2, deals.A.opportunities(t2)))
    assert all({x.opportunity_id for x in r._tapes} == {int(r._tapes_of)} for r in once.collect()) and once.count() > 0
