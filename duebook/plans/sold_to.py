"""Who an item was sold to, and where that customer stands in the hierarchy.

The lookups are reduced to one row per key before the ledger is joined to them: the first
order of a billing document is a property of the document, not of each item that names it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from duebook.functions import blank_to_null, differs, map_company, not_blank
from duebook.functions.codes import MERGED_COMPANY, PARENT_COMPANY, flow_company
from duebook.operators.lookups import lookup_join, tiered_lookup, top1
from duebook.operators.skew import Hot
from duebook.schemas import HIERARCHY

# Document categories of the flow table.
ORDER_CATEGORIES = ["C", "H", "B", "E", "F", "G", "K", "L", "I"]
DELIVERY_CATEGORY = "J"
DELIVERY_ORDER_CATEGORIES = {"E": 1, "C": 2}

# Labels of the source of the sold-to customer.
FROM_FIRST_LINE = "ABAP_003ANL_BSEG_0048_REFRESH"
FROM_PAYER = "BSEG_KIDNO_TO_VBRK_KUNAG"
FROM_DIRECT = "VBFA_VBAK_DIRECT"
FROM_DELIVERY = "VBFA_VBAK_DELIVERY_FALLBACK"
FROM_ITEM = "ORIGINAL_BSID_BSAD_KUNNR"

# Labels of the tier that found the customer key.
TIER_OWN = "PRIMARY_BUKRS"
TIER_PARENT = "FALLBACK_0048_TO_1082"
TIER_ANY = "FALLBACK_ANY_BUKRS"
TIER_NONE = "UNRESOLVED"

DOCUMENT = ["bukrs", "belnr", "gjahr"]


def first_customer_lines(document_lines: DataFrame) -> DataFrame:
    return document_lines.where((F.col("koart") == "D") & not_blank(F.col("kunnr"))
                                & (F.col("bukrs") == MERGED_COMPANY))


def first_customer(document_lines: DataFrame) -> DataFrame:
    """Customer of the first customer line of each document of the merged company."""
    return top1(first_customer_lines(document_lines), DOCUMENT, [F.col("buzei"), F.col("kunnr")]).select(
        *DOCUMENT, F.col("kunnr").alias("first_customer"))


def _orders(order_headers: DataFrame) -> DataFrame:
    return top1(order_headers, ["vbeln"], [F.col("bukrs_vf"), F.col("kunnr")]).select(
        F.col("vbeln").alias("order_id"), F.col("bukrs_vf").alias("flow_company"),
        F.col("kunnr").alias("order_customer"), F.lit(True).alias("known"))


def direct_orders(flow: DataFrame, order_headers: DataFrame, hot: Hot | None = None) -> DataFrame:
    """First order before each billing document, per company the order was booked in."""
    steps = (flow.where(F.col("vbtyp_v").isin(ORDER_CATEGORIES))
             .select("vbeln", F.col("vbelv").alias("order_id")).distinct())
    found = lookup_join(steps, _orders(order_headers), ["order_id"], hot=hot)
    first = F.min(F.struct("order_id", "order_customer")).alias("first")
    return (found.where("known").groupBy("vbeln", "flow_company").agg(first)
            .select("vbeln", "flow_company",
                    F.col("first.order_customer").alias("direct_customer")))


def delivery_orders(flow: DataFrame, order_headers: DataFrame, hot: Hot | None = None) -> DataFrame:
    """First order behind the deliveries of each billing document.

    The smallest over all two-hop paths is the smallest over deliveries of each delivery's
    smallest, so the paths are never listed.
    """
    rank = F.lit(None).cast("int")
    for category, place in DELIVERY_ORDER_CATEGORIES.items():
        rank = F.when(F.col("vbtyp_v") == category, place).otherwise(rank)
    orders = (flow.where(F.col("vbtyp_v").isin(list(DELIVERY_ORDER_CATEGORIES)))
              .select(F.col("vbeln").alias("delivery"), F.col("vbelv").alias("order_id"),
                      rank.alias("rank")).distinct())
    path = F.struct("rank", "order_id", "order_customer")
    per_delivery = (lookup_join(orders, _orders(order_headers), ["order_id"], hot=hot)
                    .where("known").groupBy("delivery").agg(F.min(path).alias("path")))
    deliveries = (flow.where((F.col("vbtyp_v") == DELIVERY_CATEGORY)
                             & differs(F.col("vbtyp_n"), "X"))
                  .select("vbeln", F.col("vbelv").alias("delivery")).distinct())
    return (lookup_join(deliveries, per_delivery, ["delivery"], hot=hot)
            .where(F.col("path").isNotNull())
            .groupBy("vbeln").agg(F.min("path").alias("path"))
            .select("vbeln", F.col("path.order_customer").alias("delivery_customer")))


def with_flow_customers(items: DataFrame, flow: DataFrame, order_headers: DataFrame,
                        hot: Mapping[str, Hot] = {}) -> DataFrame:
    """Add ``direct_customer`` and ``delivery_customer``; needs ``bukrs`` and ``vbeln``."""
    columns = items.columns
    items = items.withColumns({
        "flow_id": F.when(not_blank(F.col("vbeln")), F.col("vbeln")),
        "flow_company": flow_company(F.col("bukrs"))})
    order = hot.get("order")
    direct = direct_orders(flow, order_headers, order).withColumnRenamed("vbeln", "flow_id")
    delivery = delivery_orders(flow, order_headers, order).withColumnRenamed("vbeln", "flow_id")
    items = lookup_join(items, direct, ["flow_id", "flow_company"], hot=hot.get("flow"))
    items = lookup_join(items, delivery, ["flow_id"], hot=hot.get("billing"))
    return items.select(*columns, "direct_customer", "delivery_customer")


def flow_table(flow: DataFrame, order_headers: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Per billing document the customers both ways of the flow lead to.

    The direct way gives one per company the orders were booked in, kept as a map.
    """
    direct = direct_orders(flow, order_headers, hot).where(F.col("flow_company").isNotNull())
    direct = direct.select("vbeln", F.struct("flow_company", "direct_customer").alias("direct"))
    rows = direct.unionByName(delivery_orders(flow, order_headers, hot), True)
    return rows.groupBy(F.col("vbeln").alias("flow_id")).agg(
        F.map_from_entries(F.collect_list("direct")).alias("direct"),
        F.max("delivery_customer").alias("delivery_customer"))


def with_flow(items: DataFrame, flow: DataFrame, hot: Hot | None = None,
              ids: Sequence[str] | None = None) -> DataFrame:
    """Add ``direct_customer`` and ``delivery_customer`` from ``flow_table`` in one lookup."""
    items = items.withColumn("flow_id", F.when(not_blank(F.col("vbeln")), F.col("vbeln")))
    items = lookup_join(items, flow, ["flow_id"], hot=hot, ids=ids)
    company = flow_company(F.col("bukrs"))
    return items.withColumn("direct_customer", F.try_element_at("direct", company)).drop(
        "direct", "flow_id")


def account_table(customers: DataFrame) -> DataFrame:
    """Per account its customer in each company as a map, and the first one of all.

    The hierarchy of a customer key is joined here, to the dimension, and so travels with
    the key.  The map has at most one entry per company.
    """
    named = customers.select("customer_key_id", *[F.col(old).alias(new)
                                                  for old, new in HIERARCHY.items()])
    levels = [F.col(c) for c in HIERARCHY.values()]
    unique = top1(named, ["customer_key_id"], levels)
    own, _ = customer_tables(customers)
    own = lookup_join(own, unique, ["customer_key_id"])
    who = F.struct("customer_key_id", *HIERARCHY.values()).alias("customer")
    first = customers.where("source_system_id = 1").groupBy(
        F.col("submitted_customer_account_number").alias("account")).agg(
            F.min(F.struct("customer_company_code", "distribution_channel_code",
                           "customer_key_id")).alias("first"))
    in_company = own.where(F.col("company").isNotNull()).groupBy("account").agg(
        F.map_from_entries(F.collect_list(F.struct("company", who))).alias("by_company"))
    first = lookup_join(first.select("account", "first.customer_key_id"), unique, ["customer_key_id"])
    return first.select("account", who.alias("anywhere")).join(in_company, "account", "left")


def with_customer(items: DataFrame, accounts: DataFrame, hot: Hot | None = None,
                  ids: Sequence[str] | None = None) -> DataFrame:
    """Customer key, the tier that found it and the hierarchy columns, in one lookup.

    The tiers are those of ``resolve_customer_key``.
    """
    items = items.withColumn("account", F.col("sold_to_customer_number"))
    items = lookup_join(items, accounts, ["account"], hot=hot, ids=ids)
    parent = F.when(F.col("bukrs") == MERGED_COMPANY, F.lit(PARENT_COMPANY))
    tiers = [(TIER_OWN, F.try_element_at("by_company", F.col("bukrs"))),
             (TIER_PARENT, F.try_element_at("by_company", parent)), (TIER_ANY, F.col("anywhere"))]
    offers = [F.when(c["customer_key_id"].isNotNull(), c) for _, c in tiers]
    tier = F.coalesce(*[F.when(o.isNotNull(), name) for o, (name, _) in zip(offers, tiers)],
                      F.lit(TIER_NONE))
    items = items.withColumns({"customer": F.coalesce(*offers), "customer_key_resolution_tier": tier})
    return items.withColumns({c: F.col(f"customer.{c}") for c in ("customer_key_id", *HIERARCHY.values())}
                             ).drop("customer", "by_company", "anywhere", "account")


def with_sold_to(items: DataFrame) -> DataFrame:
    """Choose the sold-to customer among the candidates, and say where it came from."""
    payer = blank_to_null(F.col("payer"))
    first = F.when(F.col("bukrs") == MERGED_COMPANY, F.col("first_customer"))
    candidates = [(first, FROM_FIRST_LINE), (payer, FROM_PAYER),
                  (F.col("direct_customer"), FROM_DIRECT),
                  (F.col("delivery_customer"), FROM_DELIVERY)]
    source = F.coalesce(*[F.when(c.isNotNull(), label) for c, label in candidates],
                        F.lit(FROM_ITEM))
    return items.withColumns({
        "sold_to_customer_number": F.coalesce(*[c for c, _ in candidates], F.col("kunnr")),
        "sold_to_resolution_source": source,
        "mapped_company_code": map_company(F.col("bukrs"))})


def customer_tables(customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Customer key per (account, company), and per account over all companies."""
    known = customers.where("source_system_id = 1").select(
        F.col("submitted_customer_account_number").alias("account"),
        F.col("customer_company_code").alias("company"),
        F.col("distribution_channel_code").alias("channel"), "customer_key_id")
    key = F.col("customer_key_id")
    own = top1(known, ["account", "company"], [F.col("channel"), key])
    anywhere = top1(known, ["account"], [F.col("company"), F.col("channel"), key])
    return own.drop("channel"), anywhere.select("account", "customer_key_id")


def resolve_customer_key(items: DataFrame, customers: DataFrame,
                         hot: Mapping[str, Hot] = {}) -> DataFrame:
    """Add ``customer_key_id`` and the tier that found it.

    The account is looked up in the item's own company, for the merged company then in its
    parent, and at last in any company.
    """
    columns = items.columns
    own, anywhere = customer_tables(customers)
    account = F.col("sold_to_customer_number")
    items = items.withColumns({
        "account": account, "company": F.col("bukrs"),
        "parent_account": F.when(F.col("bukrs") == MERGED_COMPANY, account)})
    parent = own.where(F.col("company") == PARENT_COMPANY).select(
        F.col("account").alias("parent_account"), "customer_key_id")
    tiers = [(TIER_OWN, own, ["account", "company"]), (TIER_PARENT, parent, ["parent_account"]),
             (TIER_ANY, anywhere, ["account"])]
    account_hot = hot.get("account")
    found = tiered_lookup(items, tiers, "customer_key_id", "customer_key_resolution_tier",
                          TIER_NONE, hot=[hot.get("account_company"), account_hot, account_hot])
    return found.select(*columns, "customer_key_id", "customer_key_resolution_tier")


def enrich_hierarchy(items: DataFrame, customers: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Add the hierarchy columns of ``customer_key_id``."""
    named = customers.select("customer_key_id", *[F.col(old).alias(new)
                                                  for old, new in HIERARCHY.items()])
    unique = top1(named, ["customer_key_id"], [F.col(c) for c in HIERARCHY.values()])
    return lookup_join(items, unique, ["customer_key_id"], hot=hot)
