"""The composed receivables operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duebook import functions as fn
from duebook.operators.aging import aging_as_of, aging_live
from duebook.operators.lookups import lookup_join
from duebook.operators.prorate import apportion, group_totals, prorate, share
from duebook.operators.skew import Hot, hot_keys
from duebook.plans import delta, invoice, sku, sold_to
from duebook.schemas import INVOICE_COLUMNS
from duebook.session import passing_steps
from duebook.sources import tables
from duebook.sources.ledger import ledger_items

from . import oracles
from .frames import AS_OF, Frames
from .oracles import DAY
from .registry import database, query

col, lit = F.col, F.lit


def items(f: Frames) -> DataFrame:
    return ledger_items(f["open_items"], f["cleared_items"])


def invoice_tables(f: Frames) -> dict[str, DataFrame]:
    return f.tables([*invoice.TABLES, "security_tags"])


# --- invoice ------------------------------------------------------------------------------

@query("ledger_items", "open_items", "cleared_items", sql=f"""
    with {oracles.LEDGERS}
    select * replace (cast(wrbtr as double) as wrbtr, cast(dmbtr as double) as dmbtr) from both_ledgers""")
def both_ledgers(f: Frames) -> DataFrame:
    return items(f)


def with_sold_to(f: Frames) -> DataFrame:
    """Items of both ledgers with the candidates and the chosen sold-to customer."""
    rows = items(f).select("bukrs", "belnr", "gjahr", "buzei", "vbeln", "kunnr").distinct()
    rows = invoice.with_document_lines(rows, f["document_lines"])
    rows = lookup_join(rows, sold_to.first_customer(f["document_lines"]), sold_to.DOCUMENT, spread=False)
    payers = f["billing_headers"].select(col("vbeln").alias("kidno"), col("kunag").alias("payer"))
    rows = lookup_join(rows, payers, ["kidno"])
    return sold_to.with_sold_to(
        sold_to.with_flow_customers(rows, f["document_flow"], f["order_headers"]))


KEYS = "bukrs, belnr, gjahr, buzei"


@query("resolve_sold_to", *oracles.SOLD_TO_FRAMES, sql=f"""
    with {oracles.SOLD_TO}
    select {KEYS}, sold_to_customer_number, sold_to_resolution_source, payer, direct_customer,
           delivery_customer, first_customer from sold""")
def resolve_sold_to(f: Frames) -> DataFrame:
    return with_sold_to(f).select(
        *invoice.ITEM, "sold_to_customer_number", "sold_to_resolution_source", "payer",
        "direct_customer", "delivery_customer", "first_customer")


@query("map_company", "ledger_columns", sql="""
    select k, bukrs, case bukrs when '0048' then '1082' else bukrs end mapped_company_code
    from ledger_columns""")
def map_company(f: Frames) -> DataFrame:
    return f["ledger_columns"].select("k", "bukrs", fn.map_company(col("bukrs")).alias("mapped_company_code"))


@query("resolve_customer_key", *oracles.SOLD_TO_FRAMES, sql=f"""
    with {oracles.SOLD_TO}
    select {KEYS}, sold_to_customer_number, customer_key_id, customer_key_resolution_tier from resolved""")
def resolve_customer_key(f: Frames) -> DataFrame:
    return sold_to.resolve_customer_key(with_sold_to(f), f["customers_current"]).select(
        *invoice.ITEM, "sold_to_customer_number", "customer_key_id", "customer_key_resolution_tier")


@query("enrich_hierarchy", *oracles.SOLD_TO_FRAMES, sql=f"""
    with {oracles.SOLD_TO}
    select {KEYS}, customer_key_id, {oracles.HIERARCHY_SQL}
    from resolved left join customers_current d using (customer_key_id)""")
def enrich_hierarchy(f: Frames) -> DataFrame:
    rows = sold_to.resolve_customer_key(with_sold_to(f), f["customers_current"])
    rows = rows.select(*invoice.ITEM, "customer_key_id")
    return sold_to.enrich_hierarchy(rows, f["customers_current"])


LINE_ON = """d.bukrs = l.bukrs and d.belnr = l.belnr and d.gjahr = l.gjahr
    and ltrim(d.buzei, '0') = ltrim(l.buzei, '0')"""


@query("due_date", "ledger_columns", "document_lines", "payment_terms", sql=f"""
    select k, cast(cast({oracles.parse("case when coalesce(zfbdt, '') in ('', '00000000') then bldat else zfbdt end")}
           + cast(case when shkzg = 'H' and coalesce(rebzg, '') = '' then 0
             else coalesce(nullif(try_cast(zbd3t as int), 0), nullif(try_cast(zbd2t as int), 0),
                           nullif(try_cast(zbd1t as int), 0), terms_days, 0) end as int) as date) as varchar) due_date
    from ledger_columns l left join document_lines d on {LINE_ON}
    left join (select zterm, max(try_cast(ztag1 as int)) terms_days from payment_terms group by 1) t using (zterm)""")
def due_date(f: Frames) -> DataFrame:
    rows = invoice.with_document_lines(f["ledger_columns"], f["document_lines"])
    rows = lookup_join(rows, invoice.payment_terms(f["payment_terms"]), ["zterm"])
    due = fn.due_date(col("zfbdt"), col("bldat"), col("shkzg"), col("rebzg"),
                      [col("zbd3t"), col("zbd2t"), col("zbd1t")], col("terms_days"))
    return rows.select("k", due.alias("due_date"))


def with_parts(f: Frames) -> DataFrame:
    return invoice.with_breakdown(f["ledger_columns"], f["breakdown_lines"])


PART_ON = "b.bukrs = l.bukrs and b.belnr = l.belnr and b.gjahr = l.gjahr and b.buzei = l.buzei"
SIGNED = "case {1} when 'H' then -round({0}, 3) else round({0}, 3) end"


@query("document_amount", "ledger_columns", "breakdown_lines", sql=f"""
    select k, auzei, cast(case when auzei is null or auzei = 1 then {SIGNED.format('wrbtr', 'l.shkzg')}
           else 0 end as double) amount
    from ledger_columns l left join breakdown_lines b on {PART_ON}""")
def document_amount(f: Frames) -> DataFrame:
    amount = invoice.document_amount(col("wrbtr"), col("shkzg"), col("auzei"))
    return with_parts(f).select("k", "auzei", amount.alias("amount"))


@query("functional_amount", "ledger_columns", "breakdown_lines", "currency_decimals", sql=f"""
    select k, auzei, round(cast(coalesce({SIGNED.format('b.dmbtr', 'b.shkzg')},
           {SIGNED.format('l.dmbtr', 'l.shkzg')}) as double) * power(10, 2 - coalesce(currdec, 2)), 3) amount
    from ledger_columns l left join breakdown_lines b on {PART_ON}
    left join currency_decimals on currkey = waers""")
def functional_amount(f: Frames) -> DataFrame:
    rows = lookup_join(with_parts(f), f["currency_decimals"].withColumnRenamed("currkey", "waers"), ["waers"])
    amount = invoice.functional_amount((col("part_amount"), col("part_sign")),
                                       (col("dmbtr"), col("shkzg")), col("currdec"))
    return rows.select("k", "auzei", amount.alias("amount"))


@query("actual_rate_amount", "ledger_columns", "dated_rates", sql=f"""
    select k, coalesce(cast(wrbtr as double) * cast(exchange_rate as double)
                       * cast(target_currency_ratio as double)
                       / nullif(cast(from_currency_ratio as double), 0), cast(wrbtr as double)) amount
    from ledger_columns left join dated_rates on from_currency = waers
      and reference_date = coalesce({oracles.parse('augdt')}, {oracles.parse('budat')})""")
def actual_rate_amount(f: Frames) -> DataFrame:
    rows = f["ledger_columns"].select("k", col("waers").alias("company_currency"), "wrbtr",
                                      invoice.rate_day(col("augdt"), col("budat")).alias("rate_day"))
    rows = lookup_join(rows, invoice.dated_rates(f["dated_rates"]), ["rate_day", "company_currency"])
    amount = invoice.actual_rate_amount(col("wrbtr"), col("exchange_rate"), col("from_currency_ratio"),
                                        col("target_currency_ratio"))
    return rows.select("k", amount.alias("amount"))


@query("budget_rate_amount", "ledger_columns", "budget_rates", sql=f"""
    select k, cast(wrbtr as double) * cast("currency_exchange_rate_to_USD_multiplier_factor" as double) amount
    from ledger_columns left join budget_rates on currency_code = waers
     and currency_exchange_rate_type_code = 1 and effective_from_date <= {DAY} and effective_to_date >= {DAY}""")
def budget_rate_amount(f: Frames) -> DataFrame:
    rates = invoice.budget_multipliers(f["budget_rates"], AS_OF).withColumnRenamed("company_currency", "waers")
    rows = lookup_join(f["ledger_columns"].select("k", "waers", "wrbtr"), rates, ["waers"])
    return rows.select("k", (col("wrbtr").cast("double") * col("budget_rate")).alias("amount"))


@query("tariff_percentage", "document_lines", "billing_lines", "billing_headers", "price_conditions", sql="""
    with flagged as (
        select d.bukrs, d.belnr, d.gjahr, max(b.matnr) m from document_lines d
        join billing_lines b on b.vbeln = d.kidno and b.aubel = d.vbel2 and b.aupos = d.posn2
             and b.matnr = '1-120037-2' group by 1, 2, 3),
    rated as (select knumv, max(kbetr) v from price_conditions where kschl in ('ZTRF', 'ZTRM') group by 1)
    select d.belnr, d.buzei, cast(case when v is not null then v / 10 when m is not null then 100 else 0 end
           as double) percentage
    from document_lines d left join flagged using (bukrs, belnr, gjahr)
    left join billing_headers h on h.vbeln = d.kidno left join rated using (knumv)""")
def tariff_percentage(f: Frames) -> DataFrame:
    lines = f["document_lines"].select("bukrs", "belnr", "gjahr", "buzei", "kidno")
    lines = lookup_join(lines, invoice.tariff_documents(f["document_lines"], f["billing_lines"]),
                        sold_to.DOCUMENT, spread=False)
    values = lookup_join(f["billing_headers"].select(col("vbeln").alias("kidno"), "knumv"),
                         invoice.tariff_conditions(f["price_conditions"]), ["knumv"])
    lines = lookup_join(lines, values, ["kidno"])
    return lines.select("belnr", "buzei", invoice.tariff_percentage(
        col("tariff_value"), col("tariff_material")).alias("percentage"))


@query("profit_center_fence", "ledger_columns", "breakdown_lines", "document_lines",
       "profit_center_fence", sql=f"""
    select k, b.auzei, coalesce(b.prctr, d.prctr) center, ztedprc, eff_date
    from ledger_columns l left join document_lines d on {LINE_ON}
    left join breakdown_lines b on {PART_ON}
    left join profit_center_fence fe on fe.prctr = coalesce(b.prctr, d.prctr) and eff_date <= budat
    qualify row_number() over (partition by k, b.auzei order by eff_date desc nulls last) = 1""")
def profit_center_fence(f: Frames) -> DataFrame:
    rows = invoice.with_document_lines(with_parts(f), f["document_lines"]).withColumn(
        "profit_center_id", F.coalesce("part_center", "line_center"))
    return invoice.with_fence(rows, f["profit_center_fence"]).select(
        "k", "auzei", col("profit_center_id").alias("center"),
        col("ted_profit_center_id").alias("ztedprc"), "eff_date")


@query("resolve_business_code", "document_lines", "billing_lines", "materials", "products", sql="""
    with ranked as (
        select vbeln, "PROD_BUSLN_FNCTN_ID" code, row_number() over (partition by vbeln
               order by abs(netwr) desc nulls last, posnr, b.matnr) place
        from billing_lines b join materials m on m.matnr = b.matnr
        join products on "PROD_CODE" = prdha and "PROD_BUSLN_FNCTN_ID" <> '')
    select belnr, buzei, kidno, code business_code from document_lines
    left join ranked on vbeln = kidno and place = 1 and kidno <> ''""")
def resolve_business_code(f: Frames) -> DataFrame:
    hot = hot_keys(f["billing_lines"], {"m": ["matnr"]})["m"]
    codes = invoice.business_codes(f["billing_lines"], f["materials"], f["products"], hot)
    lines = f["document_lines"].select("belnr", "buzei", "kidno").withColumn(
        "vbeln", F.when(fn.not_empty(col("kidno")), col("kidno")))
    return lookup_join(lines, codes, ["vbeln"]).drop("vbeln")


UNITS = """left join profit_centers p on p.profit_center_id = {0} and p.record_active_indicator = 'Y'
    left join business_units u on u.business_unit_id = p.business_unit_id"""


def with_override(f: Frames) -> DataFrame:
    """Document lines; a code stands on every third, a rule on every second of them."""
    lines = f["document_lines"].select(
        "belnr", "buzei", col("prctr").alias("profit_center_id"), "bukrs",
        F.when(col("rebzg") == "", "F1").alias("business_code"),
        F.substring("kunnr", 10, 1).alias("digit"))
    lines = lines.withColumns({"industry_business_code": F.when(col("digit") < "5", "MACHINERY")
                               .otherwise("HOUSEHOLD")})
    return invoice.with_business_unit(lines, f)


OVERRIDE = f"""
    base as (
        select d.belnr, d.buzei, d.prctr, u.business_unit_id unit, u.business_unit_group_id unit_group,
               case when rebzg = '' then 'F1' end code, "SAP_PROFIT_CENTER_CDE" rule_center
        from document_lines d {UNITS.format('d.prctr')}
        left join profit_center_rules r on r."ORGANIZATION_ID" = d.bukrs
          and r."COMPETENCY_BUSINESS_CDE" = case when rebzg = '' then 'F1' end
          and r."INDUSTRY_BUSINESS_CDE" = case when substr(d.kunnr, 10, 1) < '5' and d.kunnr <> ' '
              then 'MACHINERY' when d.kunnr = ' ' then 'MACHINERY' else 'HOUSEHOLD' end),
    final as (
        select *, case when code is not null and rule_center is not null
               and (prctr is null or coalesce(unit, '') in ('', 'LGL', 'TMP', 'CRP')) then rule_center
               when code is null and unit in ('LGL', 'TMP', 'CRP') then null else prctr end final_center
        from base)"""


@query("profit_center_override", "document_lines", "profit_centers", "business_units",
       "profit_center_rules", sql=f"""
    with {OVERRIDE} select belnr, buzei, prctr, final_center from final""")
def profit_center_override(f: Frames) -> DataFrame:
    return with_override(f).select("belnr", "buzei", col("profit_center_id").alias("prctr"),
                                   col("final_profit_center_id").alias("final_center"))


@query("business_unit_final", "document_lines", "profit_centers", "business_units",
       "profit_center_rules", sql=f"""
    with {OVERRIDE}
    select belnr, buzei, coalesce(u.business_unit_group_id, unit_group) business_unit_group_id
    from final {UNITS.format('final_center')}""")
def business_unit_final(f: Frames) -> DataFrame:
    group = F.coalesce("final_business_unit_group_id", "own_business_unit_group_id")
    return with_override(f).select("belnr", "buzei", group.alias("business_unit_group_id"))


@query("security_tag", "customers", "company_dim", "security_tags", sql="""
    with keyed as (
        select customer_account_number acct, customer_company_legacy_format_account_number_rank acct_rank,
               array_to_string(list_sort(list_distinct([coalesce(customer_owning_business_unit_dsg_id, 0),
                 coalesce(sales_territory_owning_business_unit_dsg_id, 0),
                 coalesce(gam_global_business_unit_owning_business_unit_dsg_id, 0),
                 coalesce(company_dsg_id, 0), 11])), '-') security_key
        from customers left join company_dim on company_code = customer_company_code)
    select acct, acct_rank, coalesce(security_tag, security_key) data_security_tag_id
    from keyed left join security_tags using (security_key)""")
def security_tag(f: Frames) -> DataFrame:
    companies = f["company_dim"].select(col("company_code").alias("customer_company_code"), "company_dsg_id")
    rows = lookup_join(f["customers"], companies, ["customer_company_code"])
    rows = rows.withColumn("security_key", fn.security_key(
        col("customer_owning_business_unit_dsg_id"), col("sales_territory_owning_business_unit_dsg_id"),
        col("gam_global_business_unit_owning_business_unit_dsg_id"), col("company_dsg_id"), lit(11)))
    return invoice.with_security_tag(rows, f["security_tags"]).select(
        col("customer_account_number").alias("acct"),
        col("customer_company_legacy_format_account_number_rank").alias("acct_rank"),
        col("security_tag").alias("data_security_tag_id"))


@query("invoice_fact", *oracles.INVOICE_FRAMES, sql=f"""
    with {oracles.INVOICE} {oracles.text_dates('invoice', oracles.INVOICE_DATES)}""")
def invoice_fact(f: Frames) -> DataFrame:
    return invoice.invoice_fact(invoice_tables(f), AS_OF)


@query("invoice_traceability", *oracles.INVOICE_FRAMES, sql=f"""
    with {oracles.INVOICE}
    select bukrs, belnr, gjahr, buzei, auzei, sold_to_customer_number, sold_to_resolution_source,
           customer_key_resolution_tier, customer_key_id from invoice_rows""")
def invoice_traceability(f: Frames) -> DataFrame:
    return invoice.invoice_base(invoice_tables(f), AS_OF).select(
        *invoice.ITEM, "auzei", "sold_to_customer_number", "sold_to_resolution_source",
        "customer_key_resolution_tier", "customer_key_id")


SPLIT_ROWS = 100     # so that many keys of these tables count as hot


@query("invoice_fact_split", *oracles.INVOICE_FRAMES, sql=f"""
    with {oracles.INVOICE} {oracles.text_dates('invoice', oracles.INVOICE_DATES)}""")
def invoice_fact_split(f: Frames) -> DataFrame:
    """The same rows with all the ways for hot keys in use."""
    return invoice.invoice_fact(invoice_tables(f), AS_OF, hot_rows=SPLIT_ROWS)


@query("invoice_delta", *oracles.INVOICE_FRAMES, sql=f"""
    with {oracles.INVOICE} {oracles.text_dates('invoice', oracles.INVOICE_DATES)}""")
def invoice_delta(f: Frames) -> DataFrame:
    """A fact that was made before some headers, rates and customers changed, and some cleared
    items arrived, brought up to date by the documents these can reach."""
    now = invoice_tables(f)
    edits = {
        "document_headers": ("usnam = 'U3'", {"usnam": lit("U99")}),
        "dated_rates": ("month(reference_date) = 2 and from_currency = 'KWD'",
                        {"exchange_rate": lit(7).cast("decimal(18,4)")}),
        "customers_current": ("customer_key_id % 17 = 3", {"sales_office_label": lit("old office")})}
    then, changes = dict(now), {}
    for name, (which, values) in edits.items():
        changed = F.coalesce(F.expr(which), lit(False))
        then[name] = now[name].withColumns({
            c: F.when(changed, v).otherwise(col(c)) for c, v in values.items()})
        new = now[name].where(changed)
        changes[name] = new.unionByName(new.withColumns(values))
    arrived = col("belnr").endswith("7")
    then["cleared_items"] = now["cleared_items"].where(~arrived)
    changes["cleared_items"] = now["cleared_items"].where(arrived)
    table = f"{database(f.spark)}.invoice"
    with passing_steps(f.spark):
        tables.full_load(invoice.invoice_fact(then, AS_OF, split_hot_keys=False), table)
    before = f.spark.table(table)
    rows, documents = delta.delta_fact(now, changes, before, AS_OF)
    return delta.merged_fact(before, rows, documents)


# --- aging --------------------------------------------------------------------------------

BUCKETS = ["open_amount", "disputed_amount", "current_amount", "past_amount", "cleared_amount"]
ITEM_AGING = dict(status="status", due="due_date", cleared_on="clearing_date", reason="reason")


def buckets_sql(live: bool, overlap: bool = False) -> str:
    disputed = "clearing_date is null and length(reason) = 2"
    if live:
        rules = ["status = 'OPEN'", disputed,
                 f"status = 'OPEN' and due_date >= {DAY} and not (length(reason) = 2)",
                 f"status = 'OPEN' and due_date < {DAY} and not (length(reason) = 2)",
                 "status = 'CLEARED'"]
    else:
        clear = "true" if overlap else f"coalesce(not ({disputed}), true)"
        current = f"coalesce(due_date >= {DAY}, false)"
        rules = ["status = 'OPEN'", f"status = 'OPEN' and {disputed}",
                 f"status = 'OPEN' and {clear} and {current}",
                 f"status = 'OPEN' and {clear} and not {current}", "status = 'CLEARED'"]
    return ", ".join(f"cast(case when {rule} then amount else 0 end as double) {name}"
                     for rule, name in zip(rules, BUCKETS))


@query("aging_live", "items", sql=f"select k, {buckets_sql(True)} from items")
def live_aging(f: Frames) -> DataFrame:
    return aging_live(f["items"], lit(AS_OF), "amount", BUCKETS, **ITEM_AGING).select("k", *BUCKETS)


@query("aging_as_of", "items", sql=f"select k, {buckets_sql(False)} from items")
def aging_on_date(f: Frames) -> DataFrame:
    return aging_as_of(f["items"], lit(AS_OF), "amount", BUCKETS, **ITEM_AGING).select("k", *BUCKETS)


@query("aging_overlap", "items", sql=f"select k, {buckets_sql(False, True)} from items")
def aging_overlap(f: Frames) -> DataFrame:
    return aging_as_of(f["items"], lit(AS_OF), "amount", BUCKETS, dispute="overlap", **ITEM_AGING
                       ).select("k", *BUCKETS)


@query("customer_aging", "items", sql=f"""
    select account, count(*) n, {', '.join(f"round(sum({c}), 2) {c}" for c in BUCKETS)}
    from (select account, {buckets_sql(False)} from items) x group by account""")
def customer_aging(f: Frames) -> DataFrame:
    rows = aging_as_of(f["items"], lit(AS_OF), "amount", BUCKETS, **ITEM_AGING)
    return rows.groupBy("account").agg(F.count("*").alias("n"), *[
        F.round(F.sum(c), 2).alias(c) for c in BUCKETS])


# --- billing lines and the material fact -----------------------------------------------------

@query("billing_lines", "billing_lines", sql="""
    select vbeln billing_document_id, posnr billing_document_item_id, ltrim(matnr, '0') material_number,
           matnr raw_material_number, arktx billing_description, cast(lmeng as double) material_quantity,
           meins material_unit_of_measure_code, cast(netwr as double) material_billing_line_net_value,
           cast(kzwi1 as double) material_billing_line_gross_value
    from billing_lines where trim(matnr) <> ''""")
def billing_lines(f: Frames) -> DataFrame:
    return sku.billing_lines(f["billing_lines"])


PRORATE = """
    totals as (select vbeln, sum(netwr) total, count(posnr) lines from billing_lines
               where trim(matnr) <> '' group by vbeln),
    parts as (
        select b.vbeln, b.posnr, b.matnr, cast(b.kzwi1 as double) gross,
               case when total <> 0 then cast(netwr as double) / cast(total as double)
                    else {single} end part, cast(o.o_totalprice as double) amount
        from billing_lines b join totals using (vbeln)
        join orders o on lpad(cast(o_orderkey as varchar), 10, '0') = b.vbeln where trim(matnr) <> '')"""


def _prorate(f: Frames, null_single: bool) -> DataFrame:
    orders = f["orders"].select(F.lpad(col("o_orderkey").cast("string"), 10, "0").alias("vbeln"),
                                col("o_totalprice").alias("amount"))
    lines = f["billing_lines"].where(fn.not_blank(col("matnr"))).join(orders, "vbeln")
    hot = hot_keys(f["billing_lines"], {"d": ["vbeln"]})["d"]
    spread = prorate(lines, "vbeln", "netwr", "posnr", {"amount": "spread_amount"}, null_single, hot)
    return spread.select("vbeln", "posnr", "matnr", col("kzwi1").alias("gross"),
                         F.round(col("factor").cast("double"), 6).alias("factor"), "spread_amount")


_PRORATE_COLUMNS = f"""select vbeln, posnr, matnr, gross,
    round(cast(cast(cast(part as varchar) as decimal(18,10)) as double), 6) factor,
    cast({oracles.half_up('amount * part')} as double) spread_amount from parts"""


@query("prorate", "billing_lines", "orders", sql=f"""
    with {PRORATE.format(single='1.0 / lines')} {_PRORATE_COLUMNS}""")
def prorated(f: Frames) -> DataFrame:
    return _prorate(f, False)


@query("prorate_null_single", "billing_lines", "orders", sql=f"""
    with {PRORATE.format(single='1.0 / nullif(lines, 1)')} {_PRORATE_COLUMNS}""")
def prorated_null_single(f: Frames) -> DataFrame:
    return _prorate(f, True)


_EXACT_ORDER = ["posnr", "matnr", "kzwi1"]


@query("prorate_exact", "billing_lines", "orders", sql=f"""
    with {PRORATE.format(single='1.0 / lines').replace('b.matnr,', 'b.matnr, b.kzwi1,')},
    scaled as (select *, amount * part * 1000.0 exact, cast(round(amount * 1000.0) as bigint) units from parts),
    floors as (select *, cast(floor(exact) as bigint) base, floor((exact - floor(exact)) * 1048576.0) steps
               from scaled),
    placed as (
        select *, units - sum(base) over (partition by vbeln) missing, count(*) over (partition by vbeln) n,
               row_number() over (partition by vbeln order by steps desc,
                   substr(md5(concat_ws('|', posnr, matnr, kzwi1::varchar)), 1, 8), posnr, matnr, kzwi1) place
        from floors)
    select vbeln, posnr, matnr, gross, cast((base + floor(missing / n)
           + if(place <= missing - floor(missing / n) * n, 1, 0)) as double) / 1000 exact_amount from placed""")
def prorate_exact(f: Frames) -> DataFrame:
    """Parts in whole units that sum to the amount of each document."""
    orders = f["orders"].select(F.lpad(col("o_orderkey").cast("string"), 10, "0").alias("vbeln"),
                                col("o_totalprice").alias("amount"))
    lines = f["billing_lines"].where(fn.not_blank(col("matnr"))).join(orders, "vbeln")
    totals = group_totals(lines, "vbeln", "netwr", "posnr")
    hot = hot_keys(lines, {"d": ["vbeln"]})["d"]
    rows = lookup_join(lines, totals, ["vbeln"], hot=hot).withColumn(
        "part", share(col("netwr"), col("total"), col("lines")))
    exact = apportion(rows, ["vbeln"], "amount", "part", _EXACT_ORDER, "exact_amount", hot=hot)
    return exact.select("vbeln", "posnr", "matnr", col("kzwi1").alias("gross"), "exact_amount")


@query("material_enrich", "billing_lines", "materials_current", sql="""
    with described as (
        select *, ltrim(material_number, '0') plain from materials_current where source_system_id = 1
        qualify row_number() over (partition by ltrim(material_number, '0') order by material_number) = 1)
    select vbeln billing_document_id, posnr billing_document_item_id, matnr raw_material_number,
           ltrim(matnr, '0') material_number, coalesce(material_description, arktx) material_description,
           product_structure_level_3_code product_hierarchy_l3_code,
           product_structure_level_4_label product_hierarchy_l4_name,
           product_structure_level_5_label material_cbc_name
    from billing_lines left join described on plain = ltrim(matnr, '0') where trim(matnr) <> ''""")
def material_enrich(f: Frames) -> DataFrame:
    lines = sku.billing_lines(f["billing_lines"])
    hot = hot_keys(lines, {"m": ["material_number"]})["m"]
    return sku.material_enrich(lines, f["materials_current"], hot).select(
        "billing_document_id", "billing_document_item_id", "raw_material_number", "material_number",
        "material_description", "product_hierarchy_l3_code", "product_hierarchy_l4_name",
        "material_cbc_name")


def material_fact(f: Frames, lines: DataFrame | None = None) -> DataFrame:
    sources = invoice_tables(f)
    if lines is not None:
        sources["billing_lines"] = lines
    hot = invoice.find_hot(sources)
    # stored as the table it is in use, so its shuffles are given back before the fan-out
    with passing_steps(f.spark) as kept:
        base = invoice.invoice_base(sources, AS_OF, hot)
        facts, = kept(facts=invoice.invoice_columns(base, sources["security_tags"]).select(*INVOICE_COLUMNS))
    return sku.sku_fact(facts, sources["billing_lines"], f["materials_current"], AS_OF,
                        hot_items=hot.get("billing", Hot(0, {})))


@query("sku_fact", *oracles.SKU_FRAMES, sql=f"""
    with {oracles.SKU} {oracles.text_dates('sku', oracles.INVOICE_DATES)}""")
def sku_fact(f: Frames) -> DataFrame:
    return material_fact(f)


SPLIT_ITEMS = 4      # a document of more lines is cut into parts


@query("sku_keep_unmatched", *oracles.SKU_FRAMES, sql=f"""
    with {oracles.SKU}
    select accounting_document_id, accounting_document_item_id, accounting_document_breakdown_item_id,
           billing_document_item_id, raw_material_number, material_actual_rate_functional_amount
    from sku
    union all
    select accounting_document_id, accounting_document_item_id, accounting_document_breakdown_item_id,
           null, null, cast({oracles.half_up(oracles.AMOUNT)} as double)
    from invoice i where not exists (select 1 from sku_lines l
        where l.billing_document_id = i.accounting_document_item_invoice_document_id)""")
def sku_keep_unmatched(f: Frames) -> DataFrame:
    facts = invoice.invoice_fact(invoice_tables(f), AS_OF, split_hot_keys=False)
    hot = hot_keys(items(f), {"billing": ["vbeln"]}, SPLIT_ITEMS)["billing"]
    rows = sku.sku_fact(facts, f["billing_lines"], f["materials_current"], AS_OF,
                        keep_unmatched=True, hot_items=hot, hot_rows=SPLIT_ITEMS)
    return rows.select("accounting_document_id", "accounting_document_item_id",
                       "accounting_document_breakdown_item_id", "billing_document_item_id",
                       "raw_material_number", "material_actual_rate_functional_amount")
