"""Logical inputs of the lifecycle model, derived from the supplied tables.

The reference reads CRM and finance tables (opportunity, account, fees,
shipments, ...). The test tables are a TPC-H-like star schema, so each logical
oracle SQL in :mod:`cohortlens.plans.oracle` states the same rules in DuckDB
SQL; any change here must be made there too.

Money is decimal: doubles are cast to ``decimal(18,2)`` once per row and all
later arithmetic is exact, so Spark and the oracle agree to the cent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

# Fixed values of the binding.
MONEY = "decimal(18,2)"
FEE_MONEY = "decimal(18,4)"
SUPPLIER_ID_OFFSET = 1_000_000_000_000   # company id of a supplier = offset + s_suppkey

RECORD_TYPES = {                          # o_orderpriority -> record type name
    "1-URGENT": "PreSeason",
    "2-HIGH": "InSeason",
    "3-MEDIUM": "Marketplace shipments",
    "4-NOT SPECIFIED": "Trade Agreement",
    "5-LOW": "Unmapped",
}
STAGES = {"F": "Closed Won", "O": "Canceled", "P": "In Transit"}


def _dec(c: Column | str, t: str = MONEY) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(t)


def _case(col: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default))


# --------------------------------------------------------------------------- CRM

def accounts(t: Tables) -> DataFrame:
    c, n = t.customer, t.nation
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        c.c_custkey.alias("id"),
        c.c_name.alias("name"),
        F.when(c.c_custkey % 17 == 0, F.lit(None)).otherwise(c.c_mktsegment).alias("classification__c"),
        n.n_name.alias("billingcountry"),
        _dec(c.c_acctbal).alias("annualrevenue"),
        F.concat(F.lit("ACC-"), c.c_custkey.cast("string")).alias("account_number__c"),
        F.when(c.c_acctbal >= 5000, "Large").when(c.c_acctbal >= 0, "Medium")
         .otherwise("Small").alias("company_size__c"),
        F.when(c.c_acctbal < 0, "Prospect").otherwise("Customer").alias("account_type__c"),
        F.concat_ws(";", F.lit("QP"), F.when(c.c_custkey % 2 == 0, "PN")).alias("active_products__c"),
        F.concat(F.lit("FULL-"), F.lpad(c.c_custkey.cast("string"), 10, "0")).alias("full_account_id__c"),
        F.concat(F.lit("NEW "), c.c_mktsegment).alias("new_class__c"),
        F.when(c.c_custkey % 10 == 0, (c.c_custkey / 10).cast("long")).alias("parentid"),
    )


def opportunities(t: Tables) -> DataFrame:
    o = t.orders
    k, prio, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    price = _dec("o_totalprice")
    close = F.when(k % 97 == 0, F.lit(None)).otherwise(F.to_date("o_orderdate"))
    rtype = _case(prio, RECORD_TYPES, "Unmapped")
    ptype = (F.when(prio.isin("1-URGENT", "3-MEDIUM"), F.lit(None))
             .when((prio == "2-HIGH") & (k % 4 == 0), F.lit("PCP"))
             .otherwise(rtype))
    return o.select(
        k.alias("id"),
        F.concat(F.lit("OPP "), k.cast("string")).alias("name"),
        F.col("o_custkey").alias("accountid"),
        close.alias("closedate"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.date_add(close, 30)).alias("funding_date__c"),
        F.when(status == "F", close).alias("closed_won_date__c"),
        rtype.alias("record_type_name__c"),
        ptype.alias("product_type__c"),
        _case(status, STAGES, "In Transit").alias("stagename"),
        (status == "F").alias("isclosed"),
        (status == "F").alias("iswon"),
        (k % 50 == 0).alias("isdeleted"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(price).alias("gmv__c"),
        price.alias("forecasted_gmv__c"),
        (price * F.lit(0.05).cast("decimal(3,2)")).alias("expectedrevenue"),
        k.cast("string").alias("slug__c"),
        F.concat(F.lit("OPP-0"), F.lpad((k % 1000).cast("string"), 3, "0")).alias("opportunity_number__c"),
        F.concat(F.lit("TO-"), k.cast("string")).alias("oms_transaction_id__c"),
        F.concat(F.lit("012"), F.substring(prio, 1, 1)).alias("recordtypeid"),
        F.when(k % 5 == 0, F.lit(None)).when(k % 2 == 0, "Spot").otherwise("Program").alias("contract_type__c"),
        F.when(k % 6 != 0, F.date_add(close, 14)).alias("contract_ship_date__c"),
        F.when(price >= 200000, "A").when(price >= 100000, "B").otherwise("C").alias("class__c"),
        F.when(k % 13 != 0, prio).alias("account_class__c"),
        (price * F.lit(0.004).cast("decimal(4,3)")).alias("est_monthly_ps_revenue__c"),
        F.when(k % 3 != 0, price * F.lit(0.03).cast("decimal(3,2)")).alias("weighted_ps_revenue__c"),
    )


def psar(t: Tables) -> DataFrame:
    """Preseason AR report: one row per three-character deal number."""
    o = t.orders.where(F.col("o_orderkey") % 1000 < 800)
    price, status = _dec("o_totalprice"), F.col("o_orderstatus")
    return (o.groupBy(F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0").alias("id"))
            .agg(F.sum(price * F.lit(0.02).cast("decimal(3,2)")).alias("commission"),
                 F.sum(F.when(status == "P", price * F.lit(0.005).cast("decimal(4,3)"))).alias("late_fees"),
                 F.sum(F.when(status == "F", price * F.lit(0.001).cast("decimal(4,3)"))).alias("app_fee")))


def weeks(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Week calendar: every Monday from the one on or before ``first`` to the last
    on or before ``last``; bounded by the calendar, not the data."""
    monday = first - dt.timedelta(days=first.weekday())
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(monday), F.lit(last), F.expr("interval 7 days"))).alias("week_of"))


def deal_ids(t: Tables) -> DataFrame:
    o = t.orders.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 3 == 0))
    return o.select(F.col("o_orderkey").alias("opportunity_id"),
                    (F.col("o_orderkey") % 2000).alias("finance_deal_number"))


def loan_tape(t: Tables) -> DataFrame:
    l = t.lineitem
    return (l.groupBy(F.col("l_partkey").alias("deal_number"))
            .agg((F.lit(SUPPLIER_ID_OFFSET) + F.min("l_suppkey")).alias("seller_id"),
                 F.sum(_dec("l_extendedprice")).alias("_ext"))
            .select("deal_number", "seller_id",
                    F.when(F.col("deal_number") % 5 == 0, F.lit(0).cast(MONEY))
                     .otherwise(F.col("_ext") * F.lit(0.01).cast("decimal(3,2)"))
                     .cast("decimal(26,6)").alias("all_in_revenue")))


# ----------------------------------------------------------------------- finance

def fees(t: Tables) -> DataFrame:
    l = t.lineitem
    ln, rf, odd = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linenumber") % 2 == 1
    return l.select(
        F.col("l_orderkey").alias("feeable_id"),
        F.when(odd, "Shipment").otherwise("FactoringRequest").alias("feeable_type"),
        F.when(rf == "A", F.when(odd, "AdminFee").otherwise("FactoringRequestAdminFee"))
         .when(rf == "R", F.when(odd, "ApplicationFee").otherwise("FactoringRequestApplicationFee"))
         .otherwise("Other").alias("type"),
        (_dec("l_extendedprice") * _dec("l_tax")).cast(FEE_MONEY).alias("amount"),
        F.when(F.col("l_linestatus") == "F", F.lit(None))
         .when(ln == 3, F.lit("starting_balance"))
         .when(ln == 5, F.lit("Preseason Fee"))
         .otherwise(rf).alias("description"),
    )


def additional_shipment_fees(t: Tables) -> DataFrame:
    l = t.lineitem.where((F.col("l_returnflag") == "A") & (F.col("l_linenumber") <= 2))
    return l.select(F.col("l_orderkey").alias("shipment_id"),
                    (_dec("l_extendedprice") * _dec("l_discount")).cast(FEE_MONEY).alias("amount"))


def shipment_items(t: Tables) -> DataFrame:
    l = t.lineitem
    qty = F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(_dec("l_quantity"))
    return l.select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("shipment_id"),
        qty.alias("quantity"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(qty).alias("accepted_quantity"),
        _dec("l_extendedprice").alias("total_sale_price"),
    )


def notes(t: Tables) -> DataFrame:
    e = t.events
    return e.select(
        F.col("event_id").alias("note_id"),
        F.col("user_id").alias("noteable_id"),
        F.when(F.col("event_type") == "click", "Shipment")
         .when(F.col("event_type") == "error", "FactoringRequest")
         .otherwise("Other").alias("noteable_type"),
        F.col("props").alias("body"),
    )


def factoring_request_payments(t: Tables) -> DataFrame:
    l = t.lineitem.where(F.col("l_returnflag") == "R")
    return l.select(F.col("l_orderkey").alias("factoring_request_id"),
                    _dec("l_extendedprice").alias("amount"))


def asset_balance_transfers(t: Tables) -> DataFrame:
    l = t.lineitem.where(F.col("l_returnflag") == "N")
    return l.select(
        F.col("l_orderkey").alias("to_id"),
        F.when(F.col("l_linenumber") % 2 == 0, "FactoringRequest").otherwise("Shipment").alias("to_type"),
        F.when(F.col("l_linenumber") == 4, F.lit(None)).otherwise(_dec("l_quantity")).alias("amount"),
    )


def obligation_lines(t: Tables) -> DataFrame:
    """Lines of shipments and factoring requests, with what the fee, additional fee,
    item, payment and transfer inputs above have for each (NULL where they have no
    row), and the line's supplier and ship date.

    Those inputs share their key, the obligation's id, and come from one table here:
    one scan and one shuffle by the key serve them all."""
    l = t.lineitem
    ln, rf, odd = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linenumber") % 2 == 1
    price, qty = _dec("l_extendedprice"), F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(_dec("l_quantity"))
    return l.select(
        F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("supp"), F.col("l_shipdate").alias("shipped"),
        F.when(odd, "Shipment").otherwise("FactoringRequest").alias("fee_owner"),
        F.when(rf == "A", F.when(odd, "AdminFee").otherwise("FactoringRequestAdminFee"))
         .when(rf == "R", F.when(odd, "ApplicationFee").otherwise("FactoringRequestApplicationFee"))
         .otherwise("Other").alias("fee_type"),
        (price * _dec("l_tax")).cast(FEE_MONEY).alias("fee_amount"),
        F.when(F.col("l_linestatus") == "F", F.lit(None)).when(ln == 3, F.lit("starting_balance"))
         .when(ln == 5, F.lit("Preseason Fee")).otherwise(rf).alias("fee_description"),
        F.when((rf == "A") & (ln <= 2), (price * _dec("l_discount")).cast(FEE_MONEY)).alias("add_amount"),
        F.lit(True).alias("is_item"), qty.alias("item_quantity"),
        F.when(rf == "R", F.lit(None)).otherwise(qty).alias("item_accepted"), price.alias("item_price"),
        F.when(rf == "R", price).alias("pay_amount"),
        F.when(rf == "N", F.when(ln % 2 == 0, "FactoringRequest").otherwise("Shipment")).alias("transfer_to"),
        F.when((rf == "N") & (ln != 4), _dec("l_quantity")).alias("transfer_amount"))


def order_summaries(t: Tables) -> DataFrame:
    """Orders with the supplier and the ship dates of their lines (NULL without lines)."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("supp"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


def _carried(orders: DataFrame) -> list[str]:
    """Totals of an order that go along with what is derived of it."""
    return [c for c in orders.columns if c.startswith("ob_")]


def relationship_id(cust: Column, supp: Column) -> Column:
    return F.concat(F.lit("R"), cust.cast("string"), F.lit("-"), supp.cast("string"))


def relationships(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Buyers and suppliers with a common order. ``orders``: stored :func:`order_summaries`."""
    o = order_summaries(t) if orders is None else orders
    pairs = o.where(F.col("supp").isNotNull()).select(F.col("o_custkey").alias("cust"), F.col("supp")).distinct()
    return pairs.select(
        relationship_id(F.col("cust"), F.col("supp")).alias("id"),
        (F.lit(SUPPLIER_ID_OFFSET) + F.col("supp")).alias("grower_id"),
        F.col("cust").alias("distributor_id"),
        F.when(F.col("supp") % 2 == 0, F.lit(0.75).cast(MONEY)).alias("grower_marketplace_fee_percentage"),
        F.when(F.col("cust") % 3 == 0, F.lit(0.50).cast(MONEY)).alias("distributor_marketplace_fee_percentage"),
    )


def companies(t: Tables) -> DataFrame:
    n = t.nation
    cust = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("addr_state"), F.col("n_name").alias("country"))
    supp = t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        (F.lit(SUPPLIER_ID_OFFSET) + F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("addr_state"), F.col("n_name").alias("country"))
    return cust.unionByName(supp)


def _rate(v: float, scale: int = 3) -> Column:
    return F.lit(v).cast(f"decimal({scale + 1},{scale})")


def marketplace_order_id(k: Column) -> Column:
    return F.when(k % 5 == 0, k)


def shipment_percentages(k: Column) -> tuple[Column, Column]:
    """A shipment's own marketplace fee percentages: grower's, distributor's."""
    return F.when(k % 2 == 0, F.lit(1.00).cast(MONEY)), F.when(k % 3 == 0, F.lit(1.20).cast(MONEY))


def is_factored(k: Column) -> Column:
    return k % 2 == 0


def request_shipment_id(k: Column) -> Column:
    return F.when(k % 11 == 0, F.lit(None)).otherwise(k)


def marketplace_orders(t: Tables) -> DataFrame:
    """Shipment id and marketplace order id only (no line summary needed)."""
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("id"), marketplace_order_id(k).alias("marketplace_order_id"))


def shipments(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """One shipment per order. ``orders``: stored :func:`order_summaries`, whose
    totals (``ob_``) go along."""
    o = order_summaries(t) if orders is None else orders
    k, status, p = F.col("o_orderkey"), F.col("o_orderstatus"), _dec("o_totalprice")
    fin = status == "F"
    grower, distributor = shipment_percentages(k)
    return o.select(
        k.alias("id"),
        k.cast("string").alias("slug"),
        status.alias("state"),
        F.concat(F.lit("REF-"), k.cast("string")).alias("reference_no"),
        relationship_id(F.col("o_custkey"), F.col("supp")).alias("relationship_id"),
        marketplace_order_id(k).alias("marketplace_order_id"),
        F.col("o_orderdate").alias("closed_at"),
        F.when(status != "O", F.col("o_orderdate")).alias("accepted_at"),
        F.col("first_ship").alias("shipping_date"),
        F.when(fin, F.col("o_orderdate")).alias("advanced1_at"),
        F.col("last_ship").alias("collection_due_on"),
        F.when(fin, F.col("last_ship")).alias("settled_at"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(p).alias("fixed_estimated_shipment_value"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(p * _rate(0.9, 1)).alias("calc_estimated_shipment_value"),
        (p * _rate(0.015)).alias("distributor_deduction"),
        fin.alias("grower_receives_advance"),
        (k % 30 + 15).cast("int").alias("payable_days1"),
        (k % 20).cast(MONEY).alias("advance2_limit_percentage"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(p * _rate(0.5, 1)).alias("fixed_advance1"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(p * _rate(0.45, 2)).alias("calc_advance1"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(p * _rate(0.2, 1)).alias("fixed_advance2"),
        F.when(k % 12 == 0, F.lit(None)).otherwise(p * _rate(0.25, 2)).alias("calc_advance2"),
        ((k % 7).cast(MONEY) * _rate(0.5, 1)).alias("base_servicing_fee1"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(p * _rate(0.02, 2)).alias("calc_base_fee1"),
        F.when(k % 3 == 1, p * _rate(0.01, 2)).alias("calc_base_fee2"),
        F.when(k % 11 == 0, F.lit(None)).otherwise((k % 13 - 6).cast(MONEY) * _rate(0.037)).alias("daily_penalty1"),
        (p * _rate(0.005)).alias("distributor_commission"),
        F.when(k % 4 == 1, p * _rate(0.01, 2)).alias("fixed_grower_marketplace_fee"),
        F.when(k % 8 != 3, p * _rate(0.008)).alias("calc_grower_marketplace_fee"),
        grower.alias("grower_marketplace_fee_percentage"),
        F.when(k % 4 == 2, p * _rate(0.012)).alias("fixed_distributor_marketplace_fee"),
        (p * _rate(0.01, 2)).alias("calc_distributor_marketplace_fee"),
        distributor.alias("distributor_marketplace_fee_percentage"),
        (p * _rate(0.03, 2)).alias("calc_pp_fees"),
        F.when(fin, p * _rate(0.004)).alias("calc_late_fee1"),
        F.when(k % 7 == 0, p * _rate(0.002)).alias("calc_late_fee2"),
        *_carried(o),
    )


def factoring_request_ids(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").alias("id"))


def factoring_requests(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Requests for even orders. ``orders`` as in :func:`shipments`."""
    o = (order_summaries(t) if orders is None else orders).where(is_factored(F.col("o_orderkey")))
    k, status, p = F.col("o_orderkey"), F.col("o_orderstatus"), _dec("o_totalprice")
    fin = status == "F"
    return o.select(
        k.alias("id"),
        k.cast("string").alias("slug"),
        status.alias("state"),
        request_shipment_id(k).alias("shipment_id"),
        F.col("o_custkey").alias("distributor_id"),
        F.col("o_orderdate").alias("closed_at"),
        F.when(fin, F.col("o_orderdate")).alias("approved_at"),
        F.col("o_orderdate").alias("created_at"),
        F.when(status != "O", F.col("first_ship")).alias("advanced_at"),
        F.col("last_ship").alias("collection_due_on"),
        F.when(fin, F.col("last_ship")).alias("settled_at"),
        (k % 45).cast("int").alias("payable_days1"),
        (k % 15).cast(MONEY).alias("advance2_limit_percentage"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(p * _rate(0.6, 1)).alias("fixed_advance1"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(p * _rate(0.55, 2)).alias("calc_advance1"),
        (p * _rate(0.015)).alias("calc_base_fee1"),
        F.when(k % 3 == 1, p * _rate(0.005)).alias("calc_base_fee2"),
        F.when(fin, p * _rate(0.003)).alias("calc_late_fee1"),
        F.when(k % 7 == 0, p * _rate(0.001)).alias("calc_late_fee2"),
        *_carried(o),
    )


def factoring_invoices(t: Tables) -> DataFrame:
    """Invoices, one per request and part. Lines move once, to their request's id as text
    (``request_slug``), by which the ledger joins the invoices."""
    l = t.lineitem.where(F.col("l_orderkey") % 2 == 0).select(
        F.col("l_orderkey").cast("string").alias("request_slug"), "l_partkey", _dec("l_extendedprice").alias("price"))
    return (l.repartition("request_slug").groupBy("request_slug", "l_partkey")
            .agg(F.sum("price").alias("amount"))
            .select(F.col("request_slug").cast("long").alias("factoring_request_id"), "request_slug",
                    F.concat(F.lit("INV-"), F.col("request_slug"), F.lit("-"),
                             F.col("l_partkey").cast("string")).alias("invoice_number"),
                    "amount"))


def tms_report(t: Tables) -> DataFrame:
    """Second platform: one trade order per part, lines totalled per part; rows that
    repeat a part repeat nothing. They meet where parts and lines do, by the part's key."""
    tot = (t.lineitem.groupBy("l_partkey")
           .agg(F.sum(_dec("l_extendedprice")).alias("ext"), F.sum(_dec("l_quantity")).alias("qty"),
                F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
                F.count(F.lit(1)).alias("lines")))
    p = (t.part.join(tot, F.col("p_partkey") == F.col("l_partkey"))
         .select("p_partkey", "l_partkey", "p_name", "p_brand", "p_type", "p_size", (_dec("p_retailprice") * F.col("qty")).alias("retail"),
                 "ext", "qty", F.to_date("first_ship").alias("first_ship"), F.to_date("last_ship").alias("last_ship"), "lines").distinct())
    key = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("T-"), key.cast("string")).alias("trade_order_id"),
        F.lit("Closed").alias("state"),
        F.col("p_name").alias("name"),
        F.lit("USD").alias("currency_type"),
        F.col("p_brand").alias("buyer_company_name"),
        F.col("p_type").alias("company_name"),
        F.lit("").alias("receiver_company_name"),
        F.to_date("first_ship").alias("date_shipment_closed"),
        F.to_date("first_ship").alias("date_shipment_accepted"),
        F.to_date("last_ship").alias("date_shipment_shipped"),
        F.col("ext").alias("total_gmv"),
        F.col("retail").alias("estimated_gmv"),
        F.lit("").alias("seller_addr_state"),
        F.lit("").alias("dist_addr_state"),
        key.cast("string").alias("shipment_id"),
        F.lit(None).cast("string").alias("self_note_body"),
        (F.col("ext") * _rate(0.01, 2)).alias("buyer_deduction"),
        F.lit("distributor").alias("wire_receiver"),
        F.col("p_size").alias("payable_days1"),
        F.lit(0).cast(MONEY).alias("advanced_percentage"),
        (F.col("ext") * _rate(0.4, 1)).alias("total_advance_amount"),
        F.lit(None).cast("date").alias("date_shipment_advanced"),
        F.lit(None).cast("string").alias("admin_fee_notes"),
        (F.col("ext") * _rate(0.002)).alias("admin_fee"),
        (F.col("ext") * _rate(0.003)).alias("admin_fee_t"),
        (F.col("ext") * _rate(0.001)).alias("application_fee"),
        (F.col("ext") * _rate(0.004)).alias("financing_fee"),
        F.lit(0).cast(MONEY).alias("other_fee"),
        (F.col("ext") * _rate(0.006)).alias("marketplace_fee"),
        F.lit(0).cast(MONEY).alias("service_fee"),
        F.lit(0).cast(MONEY).alias("scs_fees"),
        F.lit(0).cast(MONEY).alias("quickpay_rebate_reduction_amount"),
        (F.col("ext") * _rate(0.003)).alias("total_admin_fees_with_additional"),
        (F.col("ext") * _rate(0.007)).alias("seller_all_fees"),
        (F.col("ext") * _rate(0.008)).alias("buyer_all_fees"),
        (F.col("ext") * _rate(0.015)).alias("all_fees"),
        F.lit(1.5).cast(MONEY).alias("seller_base_fee_percentage"),
        F.lit(2.5).cast(MONEY).alias("buyer_base_fee_percentage"),
        F.lit(4.0).cast(MONEY).alias("base_fee_percentage"),
        F.lit(0).cast(MONEY).alias("other_fee_percentage"),
        (F.col("ext") * _rate(0.02, 2)).alias("total_base_fees"),
        F.lit(None).cast(MONEY).alias("rebate_reduction_rate"),
        (F.col("ext") * _rate(0.005)).alias("buyer_commission"),
        (F.col("ext") * _rate(0.009)).alias("seller_marketplace_fee"),
        F.lit(0.9).cast(MONEY).alias("seller_marketplace_fee_percentage"),
        (F.col("ext") * _rate(0.011)).alias("buyer_marketplace_fee"),
        F.lit(1.1).cast(MONEY).alias("buyer_marketplace_fee_percentage"),
        (F.col("ext") * _rate(0.025)).alias("produce_pay_fee"),
        F.to_date("last_ship").alias("collection_due_on"),
        F.lit("ProducePay").alias("bank_company_name"),
        F.lit(None).cast("string").alias("company_country"),
        F.lit(None).cast("string").alias("buyer_company_country"),
        F.lit("FUL").alias("fulfillment_status_code"),
        F.lit("FUN").alias("funding_status_code"),
        F.lit("ADV").alias("advance_status_code"),
        F.to_date("last_ship").alias("max_date_invoice"),
        F.to_date("first_ship").alias("min_date_invoice"),
        F.col("lines").cast("int").alias("invoice_count"),
        F.lit("NET30").alias("contract_term_code"),
        F.lit("F1").alias("facility_code"),
        F.lit("Facility one").alias("facility_name"),
        F.lit("OK").alias("financial_status_code"),
        (F.col("ext") * _rate(0.001)).alias("total_late_fees"),
        F.when(F.col("p_size") % 2 == 0, key.cast("string")).alias("slug"),
        F.col("qty").alias("total_quantity"),
        (key % 90).cast("int").alias("days_past_due"),
        F.col("p_type").alias("product_type"),
    )
