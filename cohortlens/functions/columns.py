"""Small column expressions shared by the products.

All of them are built from ``pyspark.sql.functions`` and stay inside
whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference: product label -> product category.
QP_LABELS_V1 = ("InSeason", "QP96", "QP80", "QP Marine", "InSeason w/Quote", "QP50", "1-Click",
                "RP Trade", "Factoring", "End Buyer")
QP_LABELS_V2 = QP_LABELS_V1 + ("PCP",)
TRADING_ONLY_LABELS = ("Marketplace Members", "Marketplace shipments", "Trading only",
                       "Trade Agreement", "PN Shippers")
PRESEASON_LABEL = "PreSeason"
NULL_LABEL = "NULL"          # string sentinel for a missing class, country or product
NULL_COHORT_YEAR = 1900      # cohort year of an account without any dated deal


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def product_category(label: Column | str, version: int = 1) -> Column:
    """Exact, case-sensitive label lookup; ``version=2`` adds ``PCP``."""
    label = _col(label)
    qp = QP_LABELS_V2 if version >= 2 else QP_LABELS_V1
    return (F.when(label.isin(*qp), "QP")
            .when(label.isin(*TRADING_ONLY_LABELS), "TRADING ONLY")
            .when(label == PRESEASON_LABEL, "PRESEASON")
            .otherwise("OTHER"))


def trunc_toward_zero(value: Column, scale: int) -> Column:
    """Numeric TRUNC(value, scale) on decimals (Spark's ``trunc`` is for dates)."""
    return F.when(value >= 0, F.floor(value, scale)).otherwise(F.ceil(value, scale))


def listagg(value: str, order_by: str, sep: str = ", ") -> Column:
    """Ordered string aggregation; NULL for an all-NULL group."""
    return F.expr(f"listagg({value}, '{sep}') WITHIN GROUP (ORDER BY {order_by})")


def month_start(d: Column | str) -> Column:
    """First day of the month, as DATE (``date_trunc`` would give TIMESTAMP)."""
    return F.trunc(_col(d), "MM")


def year_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "YEAR")


def or_null_label(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(NULL_LABEL))


def date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))


def one_month() -> Column:
    return F.expr("interval 1 month")


def one_year() -> Column:
    return F.expr("interval 1 year")
