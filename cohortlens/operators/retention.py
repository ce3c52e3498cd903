"""Account-month fact, dimension scaffold and the churn report.

The reference joins the scaffold to the account-month fact with a band
condition (``month BETWEEN closed_month AND closed_month + n``) and finds
churn with a left join plus NULL test. Here:

* retention is counted by difference events: an account-month adds to its
  segment from its month on and takes the same away a month after its window ends,
  whatever n is; a running sum over a segment's months gives the report;
* churn is a ``lead`` gap test over the account's active months: an account
  churns n+1 months after an active month when its next active month is
  later than that;
* the scaffold is the (bounded) cross product of distinct dimension values
  and calendar months, never the full join of the deal base with the calendar.

Windows partition by account only over account-month rows (at most one per
calendar month), so a hot account cannot overload a task.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import date_lit, month_start, one_month, year_start
from ..sources import adapters as A
from ..sources.scratch import stored
from ..sources.tables import Tables
from .deals import qualified

REPORT_DIMS = ("account_class", "first_product_category", "cohort_ym", "country")
SCAFFOLD_DIMS = ("first_product_category", "account_class", "cohort_year", "cohort_ym", "country")


def _month(d: dt.date) -> dt.date:
    return d.replace(day=1)


def calendar_span(rows: DataFrame, start: dt.date | None, as_of: dt.date | None,
                  month: str = "closed_month") -> tuple[dt.date, dt.date] | None:
    """First month and last day that a report covers: what the caller names, else
    the first and the last observed month; None without any dated row."""
    if start is None or as_of is None:
        seen = rows.agg(F.min(month), F.max(month)).first()  # one row
        if seen[0] is None:
            return None
        start, as_of = start or seen[0], as_of or (seen[1] + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
    return start, as_of


def calendar_months(spark: SparkSession, span: tuple[dt.date, dt.date] | None) -> DataFrame:
    """Distinct (month, year) of the span's calendar weeks; a handful of rows per
    year, so it is broadcast."""
    if span is None:
        return spark.createDataFrame([], "month_idx date, year_idx date")
    start, as_of = span
    w = A.weeks(spark, start, as_of).where(F.col("week_of").between(date_lit(start), date_lit(as_of)))
    return F.broadcast(w.select(month_start("week_of").alias("month_idx"), year_start("week_of").alias("year_idx")).distinct())


def dim_scaffold(base: DataFrame, start: dt.date | None = None, as_of: dt.date | None = None,
                 dims: tuple[str, ...] = SCAFFOLD_DIMS) -> DataFrame:
    """D5 (J9): every observed dimension combination for every calendar month
    from the first to the last observed one (or between the dates given).

    The reference's FULL JOIN with no condition is a cross product; for an
    empty base it would add one all-NULL row per month, here it yields none.
    """
    months = calendar_months(base.sparkSession, calendar_span(base, start, as_of))
    return base.select(*dims).distinct().crossJoin(months)


def account_months(base: DataFrame, n: int = 12, dims: tuple[str, ...] = REPORT_DIMS,
                   account: str = "id") -> DataFrame:
    """D6 (MG): one row per account, active month and dimensions."""
    return (base.groupBy(F.col(account).alias("account_id"), "closed_month", *dims)
            .agg(F.max("account_closedate_row").alias("deals_closed"),
                 F.min("account_closedate_row").alias("min_account_closedate_row"),
                 F.min("account_revenue").alias("revenue"),
                 F.min("account_gmv").alias("gmv"))
            .withColumn("ret_date_max", F.add_months("closed_month", n))
            .withColumn("churn_date", F.add_months("closed_month", n + 1)))


def _scaffold_keys(scaffold: DataFrame, dims) -> DataFrame:
    return scaffold.select("month_idx", *dims)


def _new_sparse(mg: DataFrame, dims) -> DataFrame:
    # an account-month row is unique per account, so count(*) = count(distinct)
    return (mg.where(F.col("min_account_closedate_row") == 1)
            .groupBy(F.col("closed_month").alias("month_idx"), *dims)
            .agg(F.count(F.lit(1)).alias("new_accounts"), F.sum("revenue").alias("new_revenue"),
                 F.sum("gmv").alias("new_gmv")))


def _rolling_new(window: int, dims) -> Column:
    roll = Window.partitionBy(*dims).orderBy("month_idx").rowsBetween(-(window - 1), 0)
    return F.sum("new_accounts").over(roll)


def _covered_months(mg: DataFrame, span: tuple[dt.date, dt.date] | None) -> DataFrame:
    """Each account-month exploded into the months its retention window covers
    (clipped to the span); one output row per (account-month, covered month)."""
    if span is None:
        return mg.where("false").withColumn("month_idx", F.col("closed_month"))
    lo_c, hi_c = date_lit(_month(span[0])), date_lit(_month(span[1]))
    live = mg.where(F.col("closed_month").isNotNull() & (F.col("ret_date_max") >= lo_c)
                    & (F.col("closed_month") <= hi_c))
    return live.withColumn("month_idx", F.explode(F.sequence(
        F.greatest("closed_month", lo_c), F.least("ret_date_max", hi_c), one_month())))


def gaps(mg: DataFrame, dims: Sequence[str] = REPORT_DIMS) -> DataFrame:
    """Account-months with the account's active month before and after."""
    w = Window.partitionBy("account_id", *dims).orderBy("closed_month")
    return mg.where(F.col("closed_month").isNotNull()).withColumns({
        "prev_churn": F.lag("churn_date").over(w), "next_month": F.lead("closed_month").over(w)})


def churn_candidates(mg: DataFrame, dims: tuple[str, ...] = REPORT_DIMS) -> DataFrame:
    """Account-months with their churn month and whether the account is still
    inactive then (J14/J15 as a ``lead`` gap test)."""
    return gaps(mg, dims).drop("prev_churn").withColumn("is_churn", _lapsed())


def _lapsed() -> Column:
    return F.col("next_month").isNull() | (F.col("next_month") > F.col("churn_date"))


#: Changes of a segment in a month, whose running sums hold in the months after it:
#: accounts, money, and how many values the money is made of (none: NULL).
CHANGES = ("d_accounts", "d_revenue", "d_gmv", "d_revenues", "d_gmvs")


def difference_events(mg: DataFrame, dims: Sequence[str] = REPORT_DIMS) -> DataFrame:
    """Two events per account-month, whatever its window: one in its month, one in
    the month after the window. Per (month, dims):

    * the changes of what is retained. An account counts from its month on unless an
      earlier window still reaches it, and until a window ends with no month in it;
      its lifetime value counts once per active month inside the window;
    * the accounts that are new, and those due and lapsed (churned)."""
    rev, gmv = F.col("revenue"), F.col("gmv")

    def event(month, accounts, sign, new, due):
        nothing = F.lit(None)
        lapsed = due & _lapsed()
        zero = lambda v: F.coalesce(v, F.lit(0)) * F.lit(sign)
        return F.struct(
            month.alias("month_idx"), accounts.cast("bigint").alias("d_accounts"), zero(rev).alias("d_revenue"), zero(gmv).alias("d_gmv"),
            (rev.isNotNull().cast("int") * sign).alias("d_revenues"), (gmv.isNotNull().cast("int") * sign).alias("d_gmvs"),
            new.cast("int").alias("is_new"), F.when(new, rev).otherwise(nothing).alias("new_rev"), F.when(new, gmv).otherwise(nothing).alias("new_gmv"),
            lapsed.cast("int").alias("lapsed"), (due & ~_lapsed()).cast("int").alias("kept"),
            F.when(lapsed, rev).otherwise(nothing).alias("lost_rev"), F.when(lapsed, gmv).otherwise(nothing).alias("lost_gmv"))

    first = F.coalesce(F.col("min_account_closedate_row") == 1, F.lit(False))
    begins = F.col("prev_churn").isNull() | (F.col("prev_churn") < F.col("closed_month"))
    events = gaps(mg, dims).select(*dims, F.explode(F.array(
        event(F.col("closed_month"), begins.cast("int"), 1, first, F.lit(False)),
        event(F.col("churn_date"), -_lapsed().cast("int"), -1, F.lit(False), F.lit(True)))).alias("e")).select(*dims, "e.*")
    return events.groupBy("month_idx", *dims).agg(
        *[F.sum(c).alias(c) for c in CHANGES],
        F.sum("is_new").alias("new_accounts"), F.sum("new_rev").alias("new_revenue"), F.sum("new_gmv").alias("new_gmv"),
        F.sum("lapsed").alias("churned_accounts"), F.sum("kept").alias("_kept"), F.sum("lost_rev").alias("_rev"), F.sum("lost_gmv").alias("_gmv"))


def _over_months(mg: DataFrame, scaffold: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Every scaffold row with its month's events and the running sums up to it."""
    keys = ["month_idx", *dims]
    asked = _scaffold_keys(scaffold, dims).withColumn("_asked", F.lit(True))
    # months with events that the scaffold lacks (before its first) still count
    rows = asked.join(difference_events(mg, dims), keys, "full")
    so_far = Window.partitionBy(*dims).orderBy("month_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda c: F.coalesce(F.sum(c).over(so_far), F.lit(0))
    rows = rows.withColumns({
        "retained_accounts": total("d_accounts"),
        "ret_revenue": F.when(total("d_revenues") > 0, F.sum("d_revenue").over(so_far)),
        "ret_gmv": F.when(total("d_gmvs") > 0, F.sum("d_gmv").over(so_far))})
    return rows.where("_asked").drop("_asked", *CHANGES)


def _within(measure: str, start: dt.date | None, as_of: dt.date | None) -> Column:
    """The measure in the months from ``start`` to ``as_of`` (where given), else NULL."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("month_idx") >= date_lit(_month(start)))
    if as_of is not None:
        inside = inside & (F.col("month_idx") <= date_lit(_month(as_of)))
    return F.when(inside, F.col(measure))


def new_accounts(mg: DataFrame, scaffold: DataFrame, window: int = 12,
                 dims: tuple[str, ...] = REPORT_DIMS) -> DataFrame:
    """D7 (J10, W6): accounts whose first deal falls in the month, plus a
    rolling sum over ``window`` months per segment."""
    out = _scaffold_keys(scaffold, dims).join(_new_sparse(mg, dims), ["month_idx", *dims], "left")
    out = out.withColumn("new_accounts", F.coalesce("new_accounts", F.lit(0)))
    return out.select("month_idx", *dims, "new_accounts", _rolling_new(window, dims).alias("new_accounts_rolling"),
                      F.col("new_revenue").alias("revenue"), F.col("new_gmv").alias("gmv"))


def retained(mg: DataFrame, scaffold: DataFrame, dims: tuple[str, ...] = REPORT_DIMS,
             start: dt.date | None = None, as_of: dt.date | None = None) -> DataFrame:
    """D8 (J11): accounts active within the window ending in the month.

    Money follows the SQL report: an account's lifetime value is added once
    per active month inside the window (``money_mode="per_activity"``). Months
    outside ``start`` and ``as_of`` have no retained accounts.
    """
    return _over_months(mg, scaffold, dims).select(
        "month_idx", *dims, F.coalesce(_within("retained_accounts", start, as_of), F.lit(0)).alias("retained_accounts"),
        _within("ret_revenue", start, as_of).alias("revenue"), _within("ret_gmv", start, as_of).alias("gmv"))


def _churned_sparse(mg: DataFrame, dims) -> DataFrame:
    ch = F.col("is_churn")
    return (churn_candidates(mg, dims).groupBy(F.col("churn_date").alias("month_idx"), *dims)
            .agg(F.count(F.when(ch, 1)).alias("churned_accounts"),
                 F.sum(F.when(ch, F.col("revenue"))).alias("_rev"),
                 F.sum(F.when(ch, F.col("gmv"))).alias("_gmv"),
                 F.count(F.when(~ch, 1)).alias("_kept")))


def _churn_money(col: str) -> Column:
    # SUM(IFF(retained, 0, value)): NULL when nothing is due, 0 when all due were retained
    kept = F.coalesce("_kept", F.lit(0)) > 0
    return F.when(kept, F.coalesce(col, F.lit(0))).otherwise(F.col(col))


def churned(mg: DataFrame, scaffold: DataFrame, dims: tuple[str, ...] = REPORT_DIMS) -> DataFrame:
    """D9 (J14, G11, G12): accounts whose retention window ended the month before.

    Money keeps the SQL's NULL rules: NULL when no account-month is due in the
    month, 0 when all that are due were retained.
    """
    out = _scaffold_keys(scaffold, dims).join(_churned_sparse(mg, dims), ["month_idx", *dims], "left")
    return out.select(
        "month_idx", *dims, F.coalesce("churned_accounts", F.lit(0)).alias("churned_accounts"),
        _churn_money("_rev").alias("revenue"), _churn_money("_gmv").alias("gmv"))


def churn_report(mg: DataFrame, scaffold: DataFrame, window: int = 12,
                 dims: tuple[str, ...] = REPORT_DIMS, start: dt.date | None = None,
                 as_of: dt.date | None = None) -> DataFrame:
    """D10 (J16): new, rolling new, churned and retained-without-new accounts,
    revenue and GMV per month and segment.

    One pass over the account-months gives the events of all three measures, one
    aggregation their totals per month and segment, and one join puts them on the
    dense scaffold, whose order the running and the rolling sum share. The
    reference's inner joins drop keys with a NULL part (accounts without a dated
    deal); so does this.
    """
    keys = ["month_idx", *dims]
    whole = scaffold
    for d in keys:
        whole = whole.where(F.col(d).isNotNull())
    m = _over_months(mg, whole, dims).withColumn("new_accounts", F.coalesce("new_accounts", F.lit(0)))
    m = m.withColumns({c: _within(c, start, as_of) for c in ("retained_accounts", "ret_revenue", "ret_gmv")})
    nvl0 = lambda x: F.coalesce(F.col(x), F.lit(0))
    return m.select(
        F.col("month_idx").alias("closed_month"), *dims, "new_accounts",
        _rolling_new(window, dims).alias("new_accounts_rolling"),
        nvl0("churned_accounts").alias("churned_accounts"),
        (nvl0("retained_accounts") - F.col("new_accounts")).alias("retained_accounts_no_new"),
        (F.col("ret_revenue") - nvl0("new_revenue")).alias("retained_revenue_no_new"),
        _churn_money("_rev").alias("churned_revenue"), _churn_money("_gmv").alias("churned_gmv"),
        (F.col("ret_gmv") - nvl0("new_gmv")).alias("retained_gmv_no_new"))


# Fixed values of the reference: presentation names of the churn report (P20).
REPORT_TITLES = {
    "closed_month": "CLOSED MONTH",
    "new_accounts": "NEW ACCOUNTS",
    "new_accounts_rolling": "NEW ACCOUNTS (ROLLING WINDOW)",
    "churned_accounts": "CHURNED ACCOUNTS",
    "retained_accounts_no_new": "RETAINED ACCOUNTS (ROLLING WINDOW, NO NEW)",
    "retained_revenue_no_new": "RETAINED REVENUE (NO NEW)",
    "churned_revenue": "CHURNED REVENUE",
    "churned_gmv": "CHURNED GMV",
    "retained_gmv_no_new": "RETAINED GMV (NO NEW)",
}


def with_report_titles(report: DataFrame) -> DataFrame:
    """P20: rename the report's columns to the reference's quoted titles
    (dimension columns are upper-cased) as a last projection."""
    return report.select(*[F.col(c).alias(REPORT_TITLES.get(c, c.upper())) for c in report.columns])


def top_report_rows(report: DataFrame, k: int = 100) -> DataFrame:
    """O1: the latest ``k`` report rows (month descending, then all keys)."""
    keys = [c for c in report.columns if c != "closed_month"][:len(REPORT_DIMS)]
    return report.orderBy(F.col("closed_month").desc(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


def global_churn_v1(t: Tables, n: int = 12, window: int = 12, start: dt.date | None = None,
                    as_of: dt.date | None = None) -> DataFrame:
    """The first churn report: no dimensions, close date, whole calendar."""
    o = qualified(A.opportunities(t))
    a = A.accounts(t).select(F.col("id").alias("a_id"))
    acct_month = stored(o.join(a, o.accountid == a.a_id)
                  .select(F.col("a_id").alias("account_id"), month_start("closedate").alias("closed_month"))
                  .where(F.col("closed_month").isNotNull()).distinct(), "active-months")
    seen = calendar_span(acct_month, None, None)
    if seen is None:
        return acct_month.select("closed_month", *[F.lit(0).cast("bigint").alias(c) for c in (
            "new_accounts", "new_accounts_rolling", "churned_accounts", "retained_accounts_no_new")])
    start, as_of = start or seen[0], as_of or seen[1]
    # the rolling sum sees every observed month, whichever of them are reported
    months = calendar_months(t.spark, (min(start, seen[0]), max(as_of, seen[1]))).select("month_idx")
    one = acct_month.withColumn("churn_date", F.add_months("closed_month", n + 1))
    event = lambda month, change, churned, new: F.struct(
        month.alias("month_idx"), change.cast("int").alias("change"), churned.cast("int").alias("churned"), new.cast("int").alias("new"))
    begins = F.col("prev_churn").isNull() | (F.col("prev_churn") < F.col("closed_month"))
    # no active month before it: the account's first; a window that lapses takes the account out
    events = gaps(one, ()).withColumn("earlier", F.col("prev_churn").isNotNull()).select(F.explode(F.array(
        event(F.col("closed_month"), begins, F.lit(0), ~F.col("earlier")),
        event(F.col("churn_date"), -_lapsed().cast("int"), _lapsed(), F.lit(0)))).alias("e")).select("e.*")
    agg = events.groupBy("month_idx").agg(*[F.sum(c).alias(c) for c in ("change", "churned", "new")])
    out = months.join(agg, "month_idx", "left").select(
        "month_idx", *[F.coalesce(x, F.lit(0)).cast("bigint").alias(x) for x in ("change", "churned", "new")])
    so_far = Window.orderBy("month_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = out.withColumn("retained", F.sum("change").over(so_far))
    # One series of calendar months (bounded), a single ordered window is fine
    roll = Window.orderBy("month_idx").rowsBetween(-(window - 1), 0)
    out = out.withColumn("new_rolling", F.sum("new").over(roll))
    return out.where(F.col("month_idx").between(date_lit(start), date_lit(as_of))).select(
        F.col("month_idx").alias("closed_month"), F.col("new").alias("new_accounts"),
        F.col("new_rolling").alias("new_accounts_rolling"), F.col("churned").alias("churned_accounts"),
        (F.col("retained") - F.col("new")).alias("retained_accounts_no_new"))


def yearly_active_by_product(base: DataFrame, scaffold: DataFrame, n: int = 12,
                             start: dt.date | None = None, as_of: dt.date | None = None) -> DataFrame:
    """Accounts active in each year by first product category.

    Revenue sums each account-month once per year it makes the account
    active (the reference's join repeats it per scaffold row of other dims).
    """
    cat = "first_product_category"
    mg = (base.groupBy(F.col("id").alias("account_id"), "closed_month", cat)
          .agg(F.sum("revenue").alias("revenue"))
          .withColumn("ret_date_max", F.add_months("closed_month", n)))
    kd = scaffold.select("month_idx", "year_idx", cat).distinct()
    cov = _covered_months(mg, calendar_span(mg, start, as_of)).join(kd, ["month_idx", cat])
    per_row = (cov.groupBy("year_idx", cat, "account_id", "closed_month")
               .agg(F.max("revenue").alias("revenue")))
    per_acct = per_row.groupBy("year_idx", cat, "account_id").agg(F.sum("revenue").alias("revenue"))
    agg = per_acct.groupBy("year_idx", cat).agg(F.count(F.lit(1)).alias("retained_accounts"),
                                                F.sum("revenue").alias("revenue"))
    years = scaffold.select("year_idx", cat).distinct()
    out = years.join(agg, ["year_idx", cat], "left")
    return out.select("year_idx", cat, F.coalesce("retained_accounts", F.lit(0)).alias("retained_accounts"),
                      "revenue")


def products_per_year(base: DataFrame) -> DataFrame:
    """D13 (G10): distinct product labels per account and close year."""
    return (base.groupBy(F.col("id").alias("account_id"), F.year("activity_date").alias("yr_close"))
            .agg(F.count_distinct("product_label").alias("product_cats")))


def products_per_closed_year(base: DataFrame) -> DataFrame:
    """D13, notebook form: distinct product labels per account key and close year;
    deals without a year are left out."""
    return (base.where(F.col("closed_year").isNotNull()).groupBy("accountid", "closed_year")
            .agg(F.count_distinct("product_label").alias("product_cats")))
