"""The invoice fact: one row per ledger item and breakdown item.

``tables`` maps the names in ``TABLES`` to DataFrames; ``as_of`` is the day for which the
budget rate is taken.  Every lookup table is made unique on its key before it is joined, so
no join but the breakdown multiplies rows and one early choice per key replaces a wide one
at the end.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

from duebook.functions import (convert_amount, currency_scale, due_date, not_empty,
                               parse_yyyymmdd, security_key, signed_amount, strip_zeros,
                               strip_zeros_regex, to_int)
from duebook.functions.dates import NO_DATE
from duebook.operators.fanout import fan_out, hot_grid
from duebook.operators.lookups import as_of_join, lookup_join, top1, valid_on
from duebook.operators.skew import Hot, hot_keys
from duebook.schemas import INVOICE_COLUMNS, require_columns
from duebook.session import passing_steps, stored
from duebook.sources.ledger import ledger_items

from .sold_to import (DOCUMENT, account_table, first_customer_lines, flow_table, with_customer,
                      with_flow, with_sold_to)

TABLES = """
    open_items cleared_items document_lines document_headers breakdown_lines billing_lines
    billing_headers document_flow order_headers price_conditions payment_terms companies
    currency_decimals dated_rates budget_rates profit_center_fence materials products
    profit_center_rules customers_current customers company_dim profit_centers business_units
""".split()

# Tariff material and price conditions, placeholder business units.
TARIFF_MATERIALS = ["1-120037-2"]
TARIFF_CONDITIONS = ["ZTRF", "ZTRM"]
PLACEHOLDER_UNITS = ["LGL", "TMP", "CRP"]

ITEM = [*DOCUMENT, "buzei"]
REFERENCE = ["kidno", "vbel2", "posn2"]
RULE_KEY = ["bukrs", "industry_business_code", "business_code"]
# Ledger columns that the large tables are asked by.
RESOLVED_BY = [*ITEM, "kunnr", "vbeln"]


# --- small lookup tables, one row per key ----------------------------------------------

def payment_terms(terms: DataFrame) -> DataFrame:
    return terms.groupBy("zterm").agg(F.max(to_int(F.col("ztag1"))).alias("terms_days"))


def tariff_conditions(conditions: DataFrame) -> DataFrame:
    return (conditions.where(F.col("kschl").isin(TARIFF_CONDITIONS))
            .groupBy("knumv").agg(F.max("kbetr").alias("tariff_value")))


def tariff_documents(document_lines: DataFrame, billing_lines: DataFrame,
                     hot: Hot | None = None) -> DataFrame:
    """Documents with a line that was billed for a tariff material."""
    return (tariff_lines(document_lines, billing_lines, hot)
            .groupBy(*DOCUMENT).agg(F.max("tariff_material").alias("tariff_material")))


def tariff_lines(document_lines: DataFrame, billing_lines: DataFrame,
                 hot: Hot | None = None) -> DataFrame:
    billed = (billing_lines.where(F.col("matnr").isin(TARIFF_MATERIALS))
              .groupBy(F.col("vbeln").alias("kidno"), F.col("aubel").alias("vbel2"),
                       F.col("aupos").alias("posn2"))
              .agg(F.max("matnr").alias("tariff_material")))
    found = lookup_join(document_lines.select(*DOCUMENT, "kidno", "vbel2", "posn2"), billed,
                        REFERENCE, hot=hot)
    return found.where(F.col("tariff_material").isNotNull()).select(*DOCUMENT, "tariff_material")


def business_codes(billing_lines: DataFrame, materials: DataFrame, products: DataFrame,
                   hot: Hot | None = None) -> DataFrame:
    """Business code of the largest line, by value, of each billing document."""
    coded = products.where(not_empty(F.col("PROD_BUSLN_FNCTN_ID"))).select(
        F.col("PROD_CODE").alias("prdha"), F.col("PROD_BUSLN_FNCTN_ID").alias("business_code"))
    coded = top1(coded, ["prdha"], [F.col("business_code")])
    per_material = lookup_join(top1(materials.select("matnr", "prdha"), ["matnr"],
                                    [F.col("prdha")]), coded, ["prdha"])
    lines = lookup_join(billing_lines.select("vbeln", "posnr", "matnr", "netwr"),
                        per_material.select("matnr", "business_code"), ["matnr"], hot=hot)
    largest = top1(lines.where(F.col("business_code").isNotNull()), ["vbeln"],
                   [F.abs("netwr").desc(), F.col("posnr"), F.col("matnr")])
    return largest.select("vbeln", "business_code")


def billing_documents(billing_headers: DataFrame, conditions: DataFrame,
                      codes: DataFrame) -> DataFrame:
    """What an item reads from its billing document: payer, tariff value, business code."""
    headers = top1(billing_headers.select("vbeln", "kunag", "knumv"), ["vbeln"],
                   [F.col("kunag"), F.col("knumv")])
    headers = lookup_join(headers, tariff_conditions(conditions), ["knumv"])
    codes = codes.where(not_empty(F.col("vbeln")))
    return (headers.join(codes, "vbeln", "full_outer")
            .select(F.col("vbeln").alias("kidno"), F.col("kunag").alias("payer"),
                    "tariff_value", "business_code"))


def company_facts(companies: DataFrame, decimals: DataFrame, budget_rates: DataFrame,
                  as_of: dt.date) -> DataFrame:
    """Currency of each company, its decimals, and its budget rate on one day."""
    currency = top1(companies.select("bukrs", F.col("waers").alias("company_currency")),
                    ["bukrs"], [F.col("company_currency")])
    places = decimals.groupBy(F.col("currkey").alias("company_currency")).agg(
        F.max("currdec").alias("currdec"))
    return lookup_join(lookup_join(currency, places, ["company_currency"]),
                       budget_multipliers(budget_rates, as_of), ["company_currency"])


def budget_multipliers(budget_rates: DataFrame, as_of: dt.date) -> DataFrame:
    rates = valid_on(budget_rates.where("currency_exchange_rate_type_code = 1"), F.lit(as_of),
                     "effective_from_date", "effective_to_date")
    rates = rates.select(
        F.col("currency_code").alias("company_currency"), "effective_from_date",
        F.col("currency_exchange_rate_to_USD_multiplier_factor").alias("budget_rate"))
    return top1(rates, ["company_currency"],
                [F.col("effective_from_date").desc(), F.col("budget_rate")]).drop(
                    "effective_from_date")


def dated_rates(rates: DataFrame) -> DataFrame:
    return top1(rates.select(
        F.col("reference_date").alias("rate_day"), F.col("from_currency").alias("company_currency"),
        "exchange_rate", "from_currency_ratio", "target_currency_ratio"),
        ["rate_day", "company_currency"], [F.col("exchange_rate")])


def customer_facts(customers: DataFrame) -> DataFrame:
    """Attributes of the ledger's own customer: active, ranked first, main source."""
    current = customers.where((F.col("source_system_id") == 1)
                              & (F.col("customer_company_legacy_format_account_number_rank") == 1)
                              & (F.col("record_active_indicator") == "Y"))
    facts = current.select(
        F.col("customer_account_number").alias("plain_account"),
        F.col("customer_company_code").alias("bukrs"), "industry_business_code",
        "customer_owning_business_unit_dsg_id", "sales_territory_owning_business_unit_dsg_id",
        "gam_global_business_unit_owning_business_unit_dsg_id",
        "sensors_alternate_sales_territory_code", "sensors_alternate_sales_territory_name")
    return top1(facts, ["plain_account", "bukrs"], [F.col(c) for c in facts.columns[2:]])


def profit_center_units(profit_centers: DataFrame, business_units: DataFrame) -> DataFrame:
    """Active business unit of each active profit centre."""
    centers = top1(profit_centers.where("record_active_indicator = 'Y'")
                   .select("profit_center_id", F.col("business_unit_id").alias("unit")),
                   ["profit_center_id"], [F.col("unit")])
    units = top1(business_units.where("record_active_indicator = 'Y'")
                 .select(F.col("business_unit_id").alias("unit"), "business_unit_dsg_id",
                         "business_unit_group_id"),
                 ["unit"], [F.col("business_unit_dsg_id")])
    known = units.withColumn("business_unit_id", F.col("unit"))
    return lookup_join(centers, known, ["unit"]).drop("unit")


# --- columns ----------------------------------------------------------------------------

def document_amount(amount: Column, debit_credit: Column, breakdown: Column) -> Column:
    """The document amount stands on the first breakdown item only."""
    first = F.coalesce(to_int(breakdown.cast("string")), F.lit(1)) == 1
    return F.when(first, signed_amount(amount, debit_credit)).otherwise(0)


def functional_amount(breakdown: tuple[Column, Column], item: tuple[Column, Column],
                      decimals: Column) -> Column:
    signed = F.coalesce(signed_amount(*breakdown), signed_amount(*item))
    return F.round(signed * currency_scale(decimals), 3)


def tariff_percentage(value: Column, material: Column) -> Column:
    return (F.when(value.isNotNull(), value / 10)
            .when(material.isNotNull(), 100).otherwise(0))


def profit_center_override(code: Column, unit: Column, center: Column, rule: Column) -> Column:
    """Profit centre that replaces a missing or placeholder one."""
    placeholder = F.coalesce(unit.isin(PLACEHOLDER_UNITS), F.lit(False))
    replaceable = placeholder | ~not_empty(unit) | center.isNull()
    return (F.when(code.isNotNull() & replaceable & rule.isNotNull(), rule)
            .when(code.isNull() & placeholder, F.lit(None))
            .otherwise(center))


def rate_day(clearing: Column, posting: Column) -> Column:
    """Clearing date, or the posting date of an item not cleared yet."""
    return F.coalesce(parse_yyyymmdd(clearing), parse_yyyymmdd(posting))


def actual_rate_amount(amount: Column, rate: Column, from_ratio: Column,
                       to_ratio: Column) -> Column:
    return F.coalesce(convert_amount(amount, rate, from_ratio, to_ratio), amount)


# --- stages -----------------------------------------------------------------------------

def find_hot(tables: Mapping[str, DataFrame], hot_rows: int | None = None) -> dict[str, Hot]:
    """Hot keys of the joins below: one pass over the key columns of four tables."""
    kw = {} if hot_rows is None else {"hot_rows": hot_rows}
    items = ledger_items(tables["open_items"], tables["cleared_items"]).withColumn(
        "plain_account", strip_zeros_regex(F.col("kunnr")))
    wanted = [
        (items, {"document": DOCUMENT, "billing": ["vbeln"], "account": ["kunnr"],
                 "plain_account": ["plain_account", "bukrs"], "company": ["bukrs"], "terms": ["zterm"]}),
        (tables["document_lines"], {"reference": ["kidno"], "center": ["prctr"],
                                    "line_reference": REFERENCE}),
        (tables["breakdown_lines"], {"breakdown": ITEM}),
        (tables["document_flow"], {"order": ["vbelv"]}),
        (tables["billing_lines"], {"material": ["matnr"]})]
    # five small jobs that do not wait for each other
    with ThreadPoolExecutor(len(wanted)) as pool:
        found = pool.map(lambda w: hot_keys(*w, **kw), wanted)
        return {name: hot for part in found for name, hot in part.items()}


def with_document_lines(items: DataFrame, document_lines: DataFrame) -> DataFrame:
    """Add reference, settled invoice and profit centre of the item's document line."""
    key = [*DOCUMENT, "item_no"]
    lines = document_lines.select(
        *DOCUMENT, strip_zeros(F.col("buzei")).alias("item_no"), "kidno", "rebzg",
        F.col("prctr").alias("line_center"))
    unique = top1(lines, key, [F.col(c) for c in ("kidno", "rebzg", "line_center")])
    items = items.withColumn("item_no", strip_zeros(F.col("buzei")))
    return lookup_join(items, unique, key, spread=False).drop("item_no")


def breakdown_parts(breakdown_lines: DataFrame, *key: Column | str) -> DataFrame:
    """The breakdown under the columns of ``key``, unique on these and the breakdown item."""
    rows = breakdown_lines.select(
        *key, "auzei", F.col("dmbtr").alias("part_amount"), F.col("shkzg").alias("part_sign"),
        F.col("prctr").alias("part_center"))
    return top1(rows, rows.columns[:-3], [F.col(c) for c in ("part_center", "part_sign", "part_amount")])


def with_breakdown(items: DataFrame, breakdown_lines: DataFrame,
                   hot: Hot | None = None) -> DataFrame:
    parts = breakdown_parts(breakdown_lines, *ITEM)
    grid = hot_grid(items, Hot(0, {}), hot) if hot else None
    return fan_out(items, parts, ITEM, grid, keep_unmatched=True)


def with_fence(items: DataFrame, fence: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Add the profit centre in force on the posting date."""
    changes = fence.select(F.col("prctr").alias("profit_center_id"), "eff_date",
                           F.col("ztedprc").alias("ted_profit_center_id"))
    return as_of_join(items, changes, ["profit_center_id"], "budat", "eff_date", hot=hot)


def one_per_item(items: DataFrame, rest: Column | None = None,
                 within: Sequence[str] = ()) -> DataFrame:
    """Of an item in both ledgers keep the newest fence date, then the cleared one.

    ``rest`` decides between rows that are alike in these, by default a hash of all columns.
    ``within`` are columns that follow from the item and that the rows are dealt by already.
    """
    rest = F.xxhash64(*items.columns) if rest is None else rest
    return top1(items, [*within, "bukrs", "kunnr", "belnr", "gjahr", "buzei", "auzei"],
                [F.col("eff_date").desc_nulls_last(), F.col("item_status"), rest])


# --- tables that hold all a key has to say ------------------------------------------------

def document_table(t: Mapping[str, DataFrame], hot: Hot | None = None) -> DataFrame:
    """User, tariff material and first customer of each document, from three tables at once.

    Their rows are united and reduced per document, so one shuffle of the ledger serves all,
    and a document with many lines sends one row per task.
    """
    lines = first_customer_lines(t["document_lines"])
    parts = [t["document_headers"].select(*DOCUMENT, F.struct("usnam").alias("header")),
             lines.select(*DOCUMENT, F.struct("buzei", "kunnr").alias("first")),
             tariff_lines(t["document_lines"], t["billing_lines"], hot)]
    rows = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    found = rows.groupBy(*DOCUMENT).agg(
        F.min("header").alias("header"), F.min("first").alias("first"),
        F.max("tariff_material").alias("tariff_material"))
    return found.select(*DOCUMENT, F.col("header.usnam").alias("usnam"),
                        F.col("header").isNotNull().alias("has_header"),
                        F.col("first.kunnr").alias("first_customer"), "tariff_material")


def center_table(fence: DataFrame, units: DataFrame) -> DataFrame:
    """Per profit centre its dated changes in order, and its own business unit.

    The list is as long as a centre has different dates.
    """
    changes = (fence.where(F.col("eff_date").isNotNull())
               .groupBy(F.col("prctr").alias("profit_center_id"), "eff_date")
               .agg(F.min(F.struct(F.col("ztedprc").alias("ted"))).alias("to"))
               .groupBy("profit_center_id")
               .agg(F.sort_array(F.collect_list(F.struct("eff_date", "to.ted"))).alias("changes")))
    own = units.withColumnsRenamed({c: f"own_{c}" for c in units.columns if c != "profit_center_id"})
    return changes.join(own, "profit_center_id", "full_outer")


def rule_table(rules: DataFrame, units: DataFrame) -> DataFrame:
    """The replacing profit centre of each rule key, and the business unit of that centre."""
    rules = rules.select(
        F.col("ORGANIZATION_ID").alias("bukrs"),
        F.col("INDUSTRY_BUSINESS_CDE").alias("industry_business_code"),
        F.col("COMPETENCY_BUSINESS_CDE").alias("business_code"),
        F.col("SAP_PROFIT_CENTER_CDE").alias("rule_center"))
    return lookup_join(top1(rules, RULE_KEY, [F.col("rule_center")]),
                       units.withColumnsRenamed({c: f"rule_{c}" for c in units.columns})
                       .withColumnRenamed("rule_profit_center_id", "rule_center"), ["rule_center"])


def company_table(t: Mapping[str, DataFrame], as_of: dt.date) -> DataFrame:
    facts = company_facts(t["companies"], t["currency_decimals"], t["budget_rates"], as_of)
    known = top1(t["company_dim"].where("record_active_indicator = 'Y'")
                 .select(F.col("company_code").alias("bukrs"), "company_dsg_id"),
                 ["bukrs"], [F.col("company_dsg_id")])
    return facts.join(known, "bukrs", "full_outer")


def line_table(t: Mapping[str, DataFrame], hot: Mapping[str, Hot] = {}) -> DataFrame:
    """Per document line its reference, and what the billing document referred to says.

    Lines have few columns, so they and not the ledger go to the billing documents.
    """
    lines = t["document_lines"].select(
        *DOCUMENT, strip_zeros(F.col("buzei")).alias("item_no"), "kidno", "rebzg",
        F.col("prctr").alias("line_center"))
    codes = business_codes(t["billing_lines"], t["materials"], t["products"], hot.get("material"))
    billed = lookup_join(lines, billing_documents(t["billing_headers"], t["price_conditions"], codes),
                         ["kidno"], hot=hot.get("reference"))
    return top1(billed, [*DOCUMENT, "item_no"], [F.col(c) for c in ("kidno", "rebzg", "line_center")])


def resolved_items(items: DataFrame, t: Mapping[str, DataFrame],
                   hot: Mapping[str, Hot] = {}) -> DataFrame:
    """All that the large tables know of an item, from the few ledger columns that lead to them.

    One row per different ``RESOLVED_BY``.  The lookup tables, and the rows before they meet the
    wide customer hierarchy, are stored one after the other, so that the disk holds the shuffles
    of one step and not of all.
    """
    ids = RESOLVED_BY
    rows = items.select(*RESOLVED_BY).withColumn("item_no", strip_zeros(F.col("buzei")))
    with passing_steps(items.sparkSession) as kept:
        lines, = stored(lines=line_table(t, hot))
        about, = stored(about=document_table(t, hot.get("line_reference")))
        flow, = stored(flow=flow_table(t["document_flow"], t["order_headers"], hot.get("order")))
        # the line is that of the item, so rows may be made unique on the shuffle of this join
        rows = lookup_join(rows, lines, [*DOCUMENT, "item_no"], spread=False).distinct()
        rows = lookup_join(rows.drop("item_no"), about, DOCUMENT,
                           hot=hot.get("document"), spread=False, ids=ids)
        rows = with_sold_to(with_flow(rows, flow, hot.get("billing"), ids))
        rows = rows.withColumn("plain_account", strip_zeros_regex(F.col("kunnr")))
        rows = lookup_join(rows, customer_facts(t["customers"]), ["plain_account", "bukrs"],
                           hot=hot.get("plain_account"), ids=ids)
        rows, accounts = kept(resolved=rows, accounts=account_table(t["customers_current"]))
    return with_customer(rows, accounts, hot.get("account"), ids)


def with_resolved(items: DataFrame, resolved: DataFrame, breakdown_lines: DataFrame,
                  hot: Hot | None = None) -> DataFrame:
    """Join the ledger to its ``resolved_items`` and its breakdown in one shuffle on ``__item``.

    Null keys of the two sides compare as equal, as fields of a struct do: they are those of the
    same rows.  An item that has a hot breakdown is cut into parts by ``fan_out``.
    """
    names = [c for c in RESOLVED_BY if c not in ITEM]

    def keyed(df: DataFrame, by: str) -> DataFrame:
        return df.select(F.struct(*ITEM).alias("__item"), F.struct(*names).alias(by),
                         *[c for c in df.columns if c not in RESOLVED_BY])
    # as two bounds: an equality would become part of the key and cost a shuffle of its own
    same = "__by <= __of and __of <= __by"
    joined = lookup_join(keyed(items, "__by"), keyed(resolved, "__of"), ["__item"], within=same, spread=False)
    if not hot:
        known = breakdown_lines.where(" and ".join(f"{c} is not null" for c in ITEM))
        joined = lookup_join(joined, breakdown_parts(known, F.struct(*ITEM).alias("__item")), ["__item"],
                             spread=False)
    joined = joined.withColumns({**{c: F.col(f"__item.{c}") for c in ITEM},
                                 **{c: F.col(f"__by.{c}") for c in names}}).drop("__by", "__of")
    return with_breakdown(joined, breakdown_lines, hot) if hot else joined


def with_center(items: DataFrame, centers: DataFrame, hot: Hot | None = None,
                ids: Sequence[str] | None = None) -> DataFrame:
    """Profit centre in force on the posting date, and the unit of the item's own centre."""
    items = lookup_join(items, centers, ["profit_center_id"], hot=hot, ids=ids)
    newest = F.try_element_at(F.filter("changes", lambda c: c["eff_date"] <= F.col("budat")), F.lit(-1))
    return items.withColumn("change", newest).withColumns({
        "eff_date": F.col("change.eff_date"),
        "ted_profit_center_id": F.col("change.ted")}).drop("change", "changes")


def invoice_base(tables: Mapping[str, DataFrame], as_of: dt.date,
                 hot: Mapping[str, Hot] = {}) -> DataFrame:
    """All enriched columns, the traceability ones among them.

    The large tables are asked by ``resolved_items``, a narrow frame of the keys of the ledger, so
    that the wide ledger itself is shuffled once, to meet it, and then joined to small tables
    only, with at most eight shuffles if none of them is broadcast.  Starts the jobs that store
    this frame and the small tables.
    """
    t = require_tables(tables)
    small = stored_small(t, as_of)
    ids = [*ITEM, "kunnr", "auzei"]
    ledger = ledger_items(t["open_items"], t["cleared_items"])
    # The hash of a ledger row stands for all its columns where one row of an item is chosen: the
    # columns that nobody reads need not come along.
    items = with_resolved(ledger.withColumn("__row", F.xxhash64(*ledger.columns)),
                          resolved_items(ledger, t, hot), t["breakdown_lines"], hot.get("breakdown"))
    items = items.withColumn("profit_center_id", F.coalesce("part_center", "line_center"))
    items = with_center(items, small["centers"], hot.get("center"), ids)
    items = one_per_item(items, F.col("__row"), ["__item"]).drop("__item", "__row")

    items = items.withColumn("rate_day", rate_day(F.col("augdt"), F.col("budat")))
    items = lookup_join(items, small["companies"], ["bukrs"], hot=hot.get("company"), ids=ids)
    items = lookup_join(items, small["terms"], ["zterm"], hot=hot.get("terms"), ids=ids)
    items = lookup_join(items, small["rates"], ["rate_day", "company_currency"], ids=ids)
    return with_final_unit(lookup_join(items, small["rules"], RULE_KEY, ids=ids))


def stored_small(t: Mapping[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """The tables that the wide ledger itself is joined to, stored, so that their size is known.

    As plans they are estimated by what they are made from, and the ledger would be shuffled to
    meet tables of a few rows.
    """
    units = profit_center_units(t["profit_centers"], t["business_units"])
    plans = {"centers": center_table(t["profit_center_fence"], units), "companies": company_table(t, as_of),
             "terms": payment_terms(t["payment_terms"]), "rates": dated_rates(t["dated_rates"]),
             "rules": rule_table(t["profit_center_rules"], units)}
    return dict(zip(plans, stored(**plans)))


def with_final_unit(items: DataFrame) -> DataFrame:
    """Override the profit centre by rule; its unit is that of the rule's centre or the own one."""
    final = profit_center_override(F.col("business_code"), F.col("own_business_unit_id"),
                                   F.col("profit_center_id"), F.col("rule_center"))
    items = items.withColumn("final_profit_center_id", final)
    center = F.col("final_profit_center_id")
    return items.withColumns({
        f"final_{c}": F.when(center == F.col("rule_center"), F.col(f"rule_{c}"))
        .when(center.isNotNull(), F.col(f"own_{c}"))
        for c in ("business_unit_id", "business_unit_dsg_id", "business_unit_group_id")})


def with_business_unit(items: DataFrame, t: Mapping[str, DataFrame]) -> DataFrame:
    """Override the profit centre by rule, and find the unit of the final one."""
    rules = t["profit_center_rules"].select(
        F.col("ORGANIZATION_ID").alias("bukrs"),
        F.col("INDUSTRY_BUSINESS_CDE").alias("industry_business_code"),
        F.col("COMPETENCY_BUSINESS_CDE").alias("business_code"),
        F.col("SAP_PROFIT_CENTER_CDE").alias("rule_center"))
    items = lookup_join(items, top1(rules, RULE_KEY, [F.col("rule_center")]), RULE_KEY)

    units = profit_center_units(t["profit_centers"], t["business_units"])
    own, final = ({c: f"{role}_{c}" for c in units.columns} for role in ("own", "final"))
    items = lookup_join(items.withColumn("own_profit_center_id", F.col("profit_center_id")),
                        units.withColumnsRenamed(own), ["own_profit_center_id"])
    items = items.withColumn("final_profit_center_id", profit_center_override(
        F.col("business_code"), F.col("own_business_unit_id"), F.col("profit_center_id"),
        F.col("rule_center")))
    return lookup_join(items, units.withColumnsRenamed(final), ["final_profit_center_id"])


def invoice_columns(base: DataFrame, security_tags: DataFrame | None = None) -> DataFrame:
    """The public columns, by name, from the columns of ``invoice_base``."""
    col = F.col
    functional = functional_amount((col("part_amount"), col("part_sign")),
                                   (col("dmbtr"), col("shkzg")), col("currdec"))
    base = base.withColumns({
        "functional": functional,
        "security_key": security_key(
            col("customer_owning_business_unit_dsg_id"),
            col("sales_territory_owning_business_unit_dsg_id"),
            col("gam_global_business_unit_owning_business_unit_dsg_id"), col("company_dsg_id"),
            F.coalesce("final_business_unit_dsg_id", "own_business_unit_dsg_id"))})
    base = with_security_tag(base, security_tags)
    item = "accounting_document_item_"
    named = {
        "company_code": col("bukrs"),
        "customer_account_number": col("kunnr"),
        "accounting_document_id": col("belnr"),
        "accounting_document_posting_fiscal_year_id": col("gjahr"),
        f"{item}id": col("buzei"),
        "accounting_document_type_code": col("blart"),
        "accounting_document_create_date": parse_yyyymmdd(col("bldat")),
        "accounting_document_posting_date": parse_yyyymmdd(col("budat")),
        f"{item}clearing_document_id": col("augbl"),
        f"{item}clearing_date": parse_yyyymmdd(col("augdt")),
        f"{item}credit_or_debit_code": col("shkzg"),
        f"{item}posting_key_used_in_payment_indicator": col("xzahl"),
        f"{item}invoice_document_id": col("vbeln"),
        f"{item}text": col("sgtxt"),
        f"{item}baseline_date": parse_yyyymmdd(col("zfbdt")),
        f"{item}due_date": due_date(col("zfbdt"), col("bldat"), col("shkzg"), col("rebzg"),
                                    [col("zbd3t"), col("zbd2t"), col("zbd1t")],
                                    col("terms_days")),
        f"{item}payment_terms_code": col("zterm"),
        f"{item}cash_discount_days_quantity_1": col("zbd1t"),
        f"{item}cash_discount_days_quantity_2": col("zbd2t"),
        "accounting_document_create_network_user_id": col("usnam"),
        f"{item}document_currency_code": col("waers"),
        f"{item}functional_currency_code": col("company_currency"),
        f"{item}payment_reason_code": col("rstgr"),
        f"{item}clearing_status_name": col("item_status"),
        "ted_overriding_profit_center_id": col("final_profit_center_id"),
        "ted_profit_center_effective_date": parse_yyyymmdd(col("eff_date")),
        "accounting_document_breakdown_item_id": col("auzei"),
        f"{item}document_currency_amount": document_amount(col("wrbtr"), col("shkzg"),
                                                           col("auzei")),
        "accouting_document_item_general_ledger_reconciliation_account_number": col("saknr"),
        f"{item}functional_currency_amount": col("functional"),
        f"{item}actual_rate_functional_amount": actual_rate_amount(
            col("functional"), col("exchange_rate"), col("from_currency_ratio"),
            col("target_currency_ratio")),
        f"{item}tariff_percentage": tariff_percentage(
            col("tariff_value"), F.when(col("has_header"), col("tariff_material"))),
        "data_security_tag_id": col("security_tag"),
        "business_unit_group_id": F.coalesce("final_business_unit_group_id",
                                             "own_business_unit_group_id"),
        f"{item}budget_rate_amount": col("functional") * col("budget_rate"),
    }
    return base.select(*[named.get(c, col(c)).alias(c) for c in INVOICE_COLUMNS])


def with_security_tag(base: DataFrame, tags: DataFrame | None, default: str | None = None
                      ) -> DataFrame:
    """Tag of the set of owning units: from ``tags(security_key, security_tag)``, else the
    default, else the key itself."""
    fallback = F.col("security_key") if default is None else F.lit(default)
    if tags is None:
        return base.withColumn("security_tag", fallback)
    return (lookup_join(base, tags.select("security_key", "security_tag"), ["security_key"])
            .withColumn("security_tag", F.coalesce("security_tag", fallback)))


def require_tables(tables: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    missing = [name for name in TABLES if name not in tables]
    if missing:
        raise ValueError(f"missing tables: {missing}")
    return tables


def invoice_fact(tables: Mapping[str, DataFrame], as_of: dt.date, split_hot_keys: bool = True,
                 hot_rows: int | None = None) -> DataFrame:
    """The invoice fact.  With ``split_hot_keys`` a first pass over the key columns looks for
    keys that hold much of a table, and their rows bypass the shuffles."""
    hot = find_hot(tables, hot_rows) if split_hot_keys else {}
    base = invoice_base(tables, as_of, hot)
    return require_columns(invoice_columns(base, tables.get("security_tags")), INVOICE_COLUMNS)
