"""KPI cubes of the notebook path, in sparse long form.

The reference builds a dense 0/1 matrix (account x month), takes a rolling
max over n+1 columns (retained), a lag test (churned) and a first-occurrence
flag (new), and multiplies the matrix by per-account totals for money. The
same numbers follow from the sparse activity rows:

* retained from an active month m on, unless an earlier window still reaches m,
  until a window of n months lapses: an event that adds in m, and one that takes
  away in m+n+1, whatever n is; running sums over a segment's months give the cube;
* churned at m+n+1 when the next active month is later (or absent) and
  m+n+1 is still inside the observed range;
* new at the first active month.

Yearly cells come from the years that a window touches (two for n up to 12). All
products read one stored roll-up of the deals, :func:`activity_layer`. Windows run
per (account, dims) over monthly rows, which is bounded by the calendar, so
a hot account cannot overload a task. The result is made dense (observed
dims x every period, zero-filled) as the matrix was.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import month_start, one_month, one_year, year_start

CUBE_DIMS = ("account_class", "first_product_category", "cohort_ym", "country")


def _kept(base: DataFrame, key: str, dims: Sequence[str]) -> DataFrame:
    keep = F.lit(True)
    for c in (key, *dims):
        keep = keep & F.col(c).isNotNull()
    return base.where(keep)


#: What is counted of an account in a period.
FLAGS = ("retained", "churned", "new")
#: Dimensions of the stored roll-up: those of every product below.
LAYER_DIMS = (*CUBE_DIMS, "ps_indicator", "product_label_category")


def activity_layer(base: DataFrame, key: str = "accountid", dims: Sequence[str] = LAYER_DIMS,
                   date: str = "activity_date") -> DataFrame:
    """Deals rolled up to (key, all dimensions, month), undated deals included, under
    the names of the deal fact: the one input of all cubes, and of their bounds
    and segments. Every product below gives the same from it as from the deals."""
    return (base.groupBy(key, *dims, month_start(date).alias(date))
            .agg(F.sum("gmv").alias("gmv"), F.sum("revenue").alias("revenue")))


def activity(base: DataFrame, key: str = "accountid", dims: Sequence[str] = CUBE_DIMS,
             date: str = "activity_date") -> DataFrame:
    """Distinct (key, dims, month) with the (key, dims) money totals.

    Rows with a NULL key or dimension are dropped (as pandas ``groupby`` does);
    undated rows still count towards the money totals.
    """
    zero = F.lit(0).cast("decimal(2,0)")
    # one aggregation and one move: the months of an account are a set bounded by the calendar
    totals = _kept(base, key, dims).groupBy(key, *dims).agg(
        F.coalesce(F.sum("gmv"), zero).alias("gmv_total"), F.coalesce(F.sum("revenue"), zero).alias("rev_total"),
        F.collect_set(month_start(date)).alias("_months"))
    return totals.select(key, *dims, F.explode("_months").alias("month"), "gmv_total", "rev_total")


def activity_bounds(base: DataFrame, key: str, dims: Sequence[str], date: str = "activity_date") -> DataFrame:
    """First and last observed month (the matrix columns): one row, broadcast.
    Taken from the base directly (partial aggregation), not from the activity rows."""
    m = month_start(date)
    return F.broadcast(_kept(base, key, dims).agg(F.min(m).alias("lo"), F.max(m).alias("hi")))


def observed_segments(base: DataFrame, key: str, dims: Sequence[str], date: str = "activity_date") -> DataFrame:
    """Distinct dimension values of the matrix rows (accounts with a dated deal)."""
    return _kept(base, key, dims).where(F.col(date).isNotNull()).select(*dims).distinct()


def _cells(period: Column, end: Column, step, next_p: Column, first_p: Column,
           churn_p: Column, hi: Column) -> Column:
    """Array of (p, r, c, nw) cells: retained periods period..end, plus the churn
    period when the account is still inactive then and it is not past ``hi``."""
    retained = F.transform(F.sequence(period, end, step), lambda x: F.struct(
        x.alias("p"), F.lit(1).alias("r"), F.lit(0).alias("c"), (x == first_p).cast("int").alias("nw")))
    churn = F.filter(F.array(F.struct(churn_p.alias("p"), F.lit(0).alias("r"), F.lit(1).alias("c"),
                                      F.lit(0).alias("nw"))),
                     lambda _: (next_p.isNull() | (next_p > churn_p)) & (churn_p <= hi))
    return F.explode(F.concat(retained, churn))


def monthly_events(act: DataFrame, key: str, dims: Sequence[str], n: int) -> DataFrame:
    """Changes and flags per (month, dims), of two events an activity row: its
    month, and the month in which its window has lapsed."""
    w = Window.partitionBy(key, *dims).orderBy("month")
    f = act.withColumns({"due": F.add_months("month", n + 1)}).withColumns({
        "prev_due": F.lag("due").over(w), "next": F.lead("month").over(w)})
    lapsed = F.col("next").isNull() | (F.col("next") > F.col("due"))
    begins = F.col("prev_due").isNull() | (F.col("prev_due") < F.col("month"))

    def event(month, change, churned, new, sign):
        return F.struct(month.alias("activity_date"), change.cast("int").alias("retained"), churned.cast("int").alias("churned"),
                        new.cast("int").alias("new"), F.lit(sign).alias("sign"))

    events = f.select(*dims, "gmv_total", "rev_total", F.explode(F.array(
        event(F.col("month"), begins, F.lit(0), F.col("prev_due").isNull(), 1),
        event(F.col("due"), -lapsed.cast("int"), lapsed, F.lit(0), -1))).alias("e")).select(*dims, "gmv_total", "rev_total", "e.*")
    money = {"gmv": "gmv_total", "rev": "rev_total"}
    return events.groupBy("activity_date", *dims).agg(
        *[F.sum(flag).alias(f"{flag}_accounts") for flag in FLAGS],
        *[F.sum(F.col(total) * F.col(flag)).alias(f"{flag}_{m}") for m, total in money.items() for flag in FLAGS],
        # once per active month inside the window
        *[F.sum(F.col(total) * F.col("sign")).alias(f"active_{m}") for m, total in money.items()])


def yearly_retained(act: DataFrame, bounds: DataFrame, key: str, dims: Sequence[str], n: int) -> DataFrame:
    """Distinct (key, dims, year) in which the account is retained."""
    w = Window.partitionBy(key, *dims).orderBy("month")
    f = act.crossJoin(bounds).withColumn("next", F.lead("month").over(w))
    end = F.least(F.add_months("month", n), F.add_months("next", -1), F.col("hi"))
    years = f.select(key, *dims, "gmv_total", "rev_total", "lo", "hi", F.explode(
        F.sequence(year_start("month"), year_start(end), one_year())).alias("year"))
    return (years.groupBy(key, *dims, "year")
            .agg(F.max("gmv_total").alias("gmv_total"), F.max("rev_total").alias("rev_total"),
                 F.max("lo").alias("lo"), F.max("hi").alias("hi")))


def yearly_cells(act: DataFrame, bounds: DataFrame, key: str, dims: Sequence[str], n: int) -> DataFrame:
    yr = yearly_retained(act, bounds, key, dims, n)
    w = Window.partitionBy(key, *dims).orderBy("year")
    f = yr.withColumns({"next": F.lead("year").over(w),
                        "first": F.min("year").over(Window.partitionBy(key, *dims))})
    cell = _cells(F.col("year"), F.col("year"), one_year(), F.col("next"), F.col("first"),
                  F.add_months("year", 12), year_start("hi"))
    return f.select(key, *dims, "gmv_total", "rev_total", "lo", "hi", cell.alias("cell"))


def _periods(bounds: DataFrame, grain: str) -> DataFrame:
    b = bounds
    if grain == "year":
        seq = F.sequence(year_start("lo"), year_start("hi"), one_year())
    else:
        seq = F.sequence(F.col("lo"), F.col("hi"), one_month())
    # bounded by the calendar span of the data
    return F.broadcast(b.select(F.explode(seq).alias("activity_date")))


def _dense(observed: DataFrame, periods: DataFrame, agg: DataFrame, keys: list[str],
           counts: list[str], moneys: list[str]) -> DataFrame:
    grid = observed.crossJoin(periods)
    out = grid.join(agg, keys, "left")
    zero = F.lit(0)
    return out.select(*keys, *[F.coalesce(c, zero).cast("bigint").alias(c) for c in counts],
                      *[F.coalesce(c, zero.cast("decimal(2,0)")).alias(c) for c in moneys])


def kpi_cube(base: DataFrame, n: int = 12, grain: str = "month", key: str = "accountid",
             dims: Sequence[str] = CUBE_DIMS, rolling_window: int | None = None,
             money_mode: str = "per_account") -> DataFrame:
    """D14 (``grain="month"``) / D15 (``grain="year"``): accounts, GMV and revenue,
    new / retained / churned, per period and segment; dense over observed
    segments x periods. ``rolling_window`` (monthly only, default n) adds the
    per-segment rolling sum of new accounts.

    ``money_mode``: ``"per_account"`` (the notebook: lifetime value once per
    retained account) or ``"per_activity"`` (the SQL report: once per active
    month inside the window; monthly grain only)."""
    if money_mode not in ("per_account", "per_activity"):
        raise ValueError(f"unknown money_mode {money_mode!r}")
    if money_mode == "per_activity" and grain == "year":
        raise ValueError("money_mode='per_activity' is defined for the monthly cube only")
    dims = list(dims)
    act, bounds = activity(base, key, dims), activity_bounds(base, key, dims)
    keys = ["activity_date", *dims]
    counts = [f"{k}_accounts" for k in FLAGS]
    moneys = [f"{k}_{m}" for m in ("gmv", "rev") for k in FLAGS]
    segments = observed_segments(base, key, dims)
    if grain == "year":
        c = yearly_cells(act, bounds, key, dims, n).select(*dims, "gmv_total", "rev_total", "cell.*")
        flag = dict(zip(FLAGS, ("r", "c", "nw"), strict=True))
        agg = c.groupBy(*dims, F.col("p").alias("activity_date")).agg(
            *[F.sum(f).alias(f"{k}_accounts") for k, f in flag.items()],
            *[F.sum(F.when(F.col(f) == 1, F.col("gmv_total"))).alias(f"{k}_gmv") for k, f in flag.items()],
            *[F.sum(F.when(F.col(f) == 1, F.col("rev_total"))).alias(f"{k}_rev") for k, f in flag.items()])
        out = _dense(segments, _periods(bounds, grain), agg, keys, counts, moneys)
    else:
        extra = ["active_gmv", "active_rev"] if money_mode == "per_activity" else []
        out = _dense(segments, _periods(bounds, grain), monthly_events(act, key, dims, n), keys, counts, [*moneys, *extra])
        # the grid has every month of a segment: a running sum over its rows
        so_far = Window.partitionBy(*dims).orderBy("activity_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        source = "active" if extra else "retained"
        out = out.withColumns({"retained_accounts": F.sum("retained_accounts").over(so_far),
                               **{f"retained_{m}": F.sum(f"{source}_{m}").over(so_far) for m in ("gmv", "rev")}})
    cols = [*keys, "retained_accounts", "churned_accounts", "new_accounts"]
    if grain != "year":
        roll = Window.partitionBy(*dims).orderBy("activity_date").rowsBetween(-((rolling_window or n) - 1), 0)
        out = out.withColumn("new_accounts_rolling", F.sum("new_accounts").over(roll))
        cols.append("new_accounts_rolling")
    out = out.withColumns({
        "retained_accounts_no_new": F.col("retained_accounts") - F.col("new_accounts"),
        "retained_gmv_no_new": F.col("retained_gmv") - F.col("new_gmv"),
        "retained_rev_no_new": F.col("retained_rev") - F.col("new_rev")})
    return out.select(*cols, "retained_accounts_no_new", "retained_gmv", "churned_gmv", "new_gmv",
                      "retained_gmv_no_new", "retained_rev", "churned_rev", "new_rev", "retained_rev_no_new")


def _yearly_counts(base: DataFrame, n: int, key: str, dims: Sequence[str], by: Sequence[str]):
    bounds = activity_bounds(base, key, dims)
    yr = yearly_retained(activity(base, key, dims), bounds, key, dims, n)
    return bounds, yr.groupBy(F.col("year").alias("activity_date"), *by)


def yearly_retained_by(base: DataFrame, by: Sequence[str], n: int = 6, key: str = "accountid",
                       dims: Sequence[str] = CUBE_DIMS) -> DataFrame:
    """S6 (export_by_dim): yearly retained accounts by some of the dims, dense
    over observed values x years (D16 per dimension, D25)."""
    by = list(by)
    bounds, g = _yearly_counts(base, n, key, dims, by)
    agg = g.agg(F.count(F.lit(1)).alias("retained_accounts"))
    return _dense(observed_segments(base, key, dims).select(*by).distinct(), _periods(bounds, "year"), agg,
                  ["activity_date", *by], ["retained_accounts"], [])


def yearly_retained_by_dim(base: DataFrame, n: int = 6, key: str = "accountid",
                           dims: Sequence[str] = CUBE_DIMS) -> DataFrame:
    """D16 (G24): the four single-dimension roll-ups in one GROUPING SETS pass,
    long form (year, dim_name, dim_value, retained_accounts)."""
    dims = list(dims)
    bounds = activity_bounds(base, key, dims)
    yr = yearly_retained(activity(base, key, dims), bounds, key, dims, n).withColumnRenamed("year", "activity_date")
    sets = [["activity_date", d] for d in dims]
    g = yr.groupingSets(sets, "activity_date", *dims).agg(
        F.count(F.lit(1)).alias("retained_accounts"), *[F.grouping(d).alias(f"_g_{d}") for d in dims])
    name = value = None
    for d in dims:
        hit = F.col(f"_g_{d}") == 0
        name = F.when(hit, F.lit(d)) if name is None else name.when(hit, F.lit(d))
        value = F.when(hit, F.col(d).cast("string")) if value is None else value.when(hit, F.col(d).cast("string"))
    agg = g.select("activity_date", name.alias("dim_name"), value.alias("dim_value"), "retained_accounts")
    observed = observed_segments(base, key, dims).select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("dim_name"), F.col(d).cast("string").alias("dim_value")) for d in dims]))
        .alias("v")).select("v.*").distinct()
    return _dense(observed, _periods(bounds, "year"), agg, ["activity_date", "dim_name", "dim_value"],
                  ["retained_accounts"], [])


def yearly_retained_by_label(base: DataFrame, n: int = 12, key: str = "accountid") -> DataFrame:
    """An account counts once per product label category it is active in."""
    return yearly_retained_by(base, ["product_label_category"], n, key, ["product_label_category"])


def cohort_table(base: DataFrame, n: int = 6, key: str = "accountid",
                 dims: Sequence[str] = CUBE_DIMS) -> DataFrame:
    """Retained accounts, revenue and GMV by cohort month and year; money
    truncated to whole numbers (X23)."""
    bounds, g = _yearly_counts(base, n, key, dims, ["cohort_ym"])
    agg = g.agg(F.count(F.lit(1)).alias("retained_accounts"),
                F.sum("rev_total").cast("bigint").alias("retained_rev"),
                F.sum("gmv_total").cast("bigint").alias("retained_gmv"))
    return _dense(observed_segments(base, key, dims).select("cohort_ym").distinct(), _periods(bounds, "year"), agg,
                  ["activity_date", "cohort_ym"], ["retained_accounts", "retained_rev", "retained_gmv"], [])


def churn_rate(cube: DataFrame) -> DataFrame:
    """D19 (G19, X22): retained-without-new and churned per period, and their
    ratio (NULL where nothing is retained)."""
    g = cube.groupBy("activity_date").agg(
        F.sum("retained_accounts_no_new").alias("retained_accounts_no_new"),
        F.sum("churned_accounts").alias("churned_accounts"))
    return g.withColumn("churn_rate", F.try_divide(F.col("churned_accounts").cast("double"),
                                                   F.col("retained_accounts_no_new").cast("double")))
