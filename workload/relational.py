"""Scans, filters, joins, aggregates, windows, sorts and unions over the receivables tables."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from duebook import functions as fn
from duebook.operators.fanout import fan_out, hot_grid
from duebook.operators.lookups import as_of_join, lookup_join, top1, valid_on, validity_join
from duebook.operators.prorate import group_totals
from duebook.operators.quality import bucket_gap
from duebook.operators.skew import hot_keys
from duebook.plans import invoice, snapshot, sold_to
from duebook.sources.ledger import ledger_items, scan

from .frames import AS_OF, Frames
from .registry import query

col, lit = F.col, F.lit
DAY = f"date '{AS_OF}'"


# --- scans --------------------------------------------------------------------------------

@query("scan_projected", "lineitem", sql="""
    select l_orderkey, l_linenumber, l_extendedprice from lineitem""")
def scan_projected(f: Frames) -> DataFrame:
    return scan(f["lineitem"], ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("scan_as_of", "snapshot", sql=f"""
    select accounting_document_id, billing_document_item_id, material_number,
           cast(snapshot_date as varchar) snapshot_date
    from snapshot where snapshot_date < {DAY} - 60""")
def scan_as_of(f: Frames) -> DataFrame:
    return scan(f["snapshot"], ["accounting_document_id", "billing_document_item_id",
                                "material_number", "snapshot_date"],
                col("snapshot_date") < F.date_sub(lit(AS_OF), 60))


@query("scan_current_dim", "materials_current", sql="""
    select material_number, material_description, product_structure_level_3_code
    from materials_current where source_system_id = 1""")
def scan_current_dim(f: Frames) -> DataFrame:
    return scan(f["materials_current"], ["material_number", "material_description",
                                         "product_structure_level_3_code"],
                col("source_system_id") == 1)


@query("temp_view_query", "items", sql="""
    select company, status, count(*) n, cast(sum(amount) as double) total
    from items group by company, status""")
def temp_view_query(f: Frames) -> DataFrame:
    f["items"].createOrReplaceTempView("duebook_items")
    return f.spark.sql("select company, status, count(*) n, sum(amount) total "
                       "from duebook_items group by all")


@query("preview_profile", "snapshot", sql=f"""
    select count(*) as "rows", cast(min(snapshot_date) as varchar) oldest,
           cast(max(snapshot_date) as varchar) newest
    from snapshot where snapshot_date < {DAY} - 60""")
def preview_profile(f: Frames) -> DataFrame:
    return snapshot.profile(snapshot.stale(f["snapshot"], AS_OF))


# --- projections and filters ----------------------------------------------------------------

@query("project_rename", "billing_lines", sql="""
    select vbeln billing_document_id, posnr billing_document_item_id, matnr raw_material_number,
           cast(netwr as double) net_value from billing_lines""")
def project_rename(f: Frames) -> DataFrame:
    return f["billing_lines"].select(
        col("vbeln").alias("billing_document_id"), col("posnr").alias("billing_document_item_id"),
        col("matnr").alias("raw_material_number"), col("netwr").alias("net_value"))


@query("project_tag", "open_items", sql="select belnr, buzei, 'OPEN' item_status from open_items")
def project_tag(f: Frames) -> DataFrame:
    return f["open_items"].select("belnr", "buzei", lit("OPEN").alias("item_status"))


@query("project_star_plus", "orders", sql="""
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           cast(cast(o_orderdate as date) as varchar) o_orderdate, o_orderpriority,
           o_orderstatus = 'F' is_cleared, o_totalprice * 2 doubled
    from orders""")
def project_star_plus(f: Frames) -> DataFrame:
    return f["orders"].withColumns({
        "o_orderdate": col("o_orderdate").cast("date"), "is_cleared": col("o_orderstatus") == "F",
        "doubled": col("o_totalprice") * 2})


FILTER_COLUMNS = ["k", "belnr", "vbeln", "rstgr", "blart", "augdt"]


def _filter(key: str, condition: str, make):
    @query(key, "ledger_columns", sql=f"""
        select {', '.join(FILTER_COLUMNS)} from ledger_columns where {condition}""")
    def run(f: Frames) -> DataFrame:
        return f["ledger_columns"].where(make()).select(*FILTER_COLUMNS)


_filter("filter_not_blank", "coalesce(trim(vbeln), '') <> ''", lambda: fn.not_blank(col("vbeln")))
_filter("filter_not_empty", "coalesce(vbeln, '') <> ''", lambda: fn.not_empty(col("vbeln")))
_filter("filter_in_list", "rstgr in ('01', 'ABC')", lambda: col("rstgr").isin("01", "ABC"))
_filter("filter_null_tolerant_ne", "rstgr is null or rstgr <> 'ABC'",
        lambda: fn.differs(col("rstgr"), "ABC"))
_filter("filter_not_length", "not (length(rstgr) = 2)", lambda: fn.not_of_length(col("rstgr"), 2))

SLICE_COLUMNS = ["accounting_document_id", "billing_document_item_id", "material_number",
                 "snapshot_date", "snapshot_state"]
SLICE_SQL = ", ".join(c if c != "snapshot_date" else "cast(snapshot_date as varchar) snapshot_date"
                      for c in SLICE_COLUMNS)


def _slice(key: str, condition: str, make):
    @query(key, "snapshot", sql=f"select {SLICE_SQL} from snapshot where {condition}")
    def run(f: Frames) -> DataFrame:
        return make(f["snapshot"]).select(*SLICE_COLUMNS)


_slice("filter_date_window", f"snapshot_date >= {DAY} - 60 and snapshot_date < {DAY}",
       lambda df: df.where((col("snapshot_date") >= F.date_sub(lit(AS_OF), 60))
                           & (col("snapshot_date") < lit(AS_OF))))
_slice("filter_older_than", f"snapshot_date < {DAY} - 60",
       lambda df: df.where(col("snapshot_date") < F.date_sub(lit(AS_OF), 60)))
_slice("filter_state_or", f"""snapshot_state = 'OPEN' or (snapshot_state = 'CLEARED'
       and accounting_document_item_clearing_date = {DAY})""",
       lambda df: df.where((col("snapshot_state") == "OPEN")
                           | ((col("snapshot_state") == "CLEARED")
                              & (col("accounting_document_item_clearing_date") == lit(AS_OF)))))
_slice("filter_state", "snapshot_state = 'OPEN'", snapshot.open_only)
_slice("filter_tolerance", """abs(material_open_functional_amount
       - (material_current_due_functional_amount + material_past_due_functional_amount
          + material_disputed_functional_amount)) > 0.01""",
       lambda df: df.where(bucket_gap() > 0.01))


@query("filter_qualify", "customers_current", sql="""
    select submitted_customer_account_number account, customer_key_id from customers_current
    where source_system_id = 1
    qualify row_number() over (partition by submitted_customer_account_number
        order by customer_company_code, distribution_channel_code nulls first, customer_key_id) = 1""")
def filter_qualify(f: Frames) -> DataFrame:
    return sold_to.customer_tables(f["customers_current"])[1]


@query("having_grouped", "lineitem", sql="""
    select l_orderkey, count(*) n from lineitem group by l_orderkey having count(*) > 5""")
def having_grouped(f: Frames) -> DataFrame:
    return f["lineitem"].groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n > 5")


@query("having_global", "snapshot", sql=f"""
    select count(*) n, cast(min(snapshot_date) as varchar) oldest from snapshot
    where snapshot_date < {DAY} - 60 having count(*) > 0""")
def having_global(f: Frames) -> DataFrame:
    return snapshot.profile(snapshot.stale(f["snapshot"], AS_OF)).where(col("rows") > 0).select(
        col("rows").alias("n"), "oldest")


# --- joins --------------------------------------------------------------------------------

@query("join_left_multikey", "ledger_columns", "document_headers", sql="""
    select l.k, l.bukrs, l.belnr, l.gjahr, h.usnam
    from ledger_columns l left join document_headers h
      on l.bukrs = h.bukrs and l.belnr = h.belnr and l.gjahr = h.gjahr""")
def join_left_multikey(f: Frames) -> DataFrame:
    return lookup_join(f["ledger_columns"].select("k", *sold_to.DOCUMENT), f["document_headers"],
                       sold_to.DOCUMENT, spread=False)


@query("join_left_reference", "ledger_columns", "companies", "currency_decimals", sql="""
    select k, bukrs, c.waers company_currency, currdec
    from ledger_columns left join companies c using (bukrs)
    left join currency_decimals on currkey = c.waers""")
def join_left_reference(f: Frames) -> DataFrame:
    companies = f["companies"].withColumnRenamed("waers", "company_currency")
    decimals = f["currency_decimals"].withColumnRenamed("currkey", "company_currency")
    items = lookup_join(f["ledger_columns"].select("k", "bukrs"), companies, ["bukrs"])
    return lookup_join(items, decimals, ["company_currency"])


@query("join_inner_chain", "billing_lines", "materials", "products", sql="""
    select vbeln, posnr, b.matnr, "PROD_BUSLN_FNCTN_ID" business_code
    from billing_lines b join materials m on b.matnr = m.matnr
    join products on prdha = "PROD_CODE" where coalesce("PROD_BUSLN_FNCTN_ID", '') <> ''""")
def join_inner_chain(f: Frames) -> DataFrame:
    coded = f["products"].where(fn.not_empty(col("PROD_BUSLN_FNCTN_ID"))).select(
        col("PROD_CODE").alias("prdha"), col("PROD_BUSLN_FNCTN_ID").alias("business_code"))
    return (f["billing_lines"].select("vbeln", "posnr", "matnr")
            .join(f["materials"].join(coded, "prdha"), "matnr")
            .select("vbeln", "posnr", "matnr", "business_code"))


@query("join_flow_direct", "ledger_columns", "document_flow", "order_headers", sql="""
    with hops as (
        select distinct k, fl.vbelv order_id, o.kunnr order_customer, o.bukrs_vf
        from ledger_columns l join document_flow fl on fl.vbeln = l.vbeln
             and fl.vbtyp_v in ('C', 'H', 'B', 'E', 'F', 'G', 'K', 'L', 'I')
        join order_headers o on o.vbeln = fl.vbelv
             and o.bukrs_vf = case when l.bukrs = '1082' then '0048' else l.bukrs end
        where trim(l.vbeln) <> '')
    select k, order_customer direct_customer from hops
    qualify row_number() over (partition by k order by order_id) = 1""")
def join_flow_direct(f: Frames) -> DataFrame:
    items = f["ledger_columns"].where(fn.not_blank(col("vbeln")))
    found = sold_to.direct_orders(f["document_flow"], f["order_headers"])
    return items.join(found, [items.vbeln == found.vbeln,
                              sold_to.flow_company(items.bukrs) == found.flow_company]).select(
        "k", "direct_customer")


@query("join_flow_two_hop", "ledger_columns", "document_flow", "order_headers", sql="""
    with hops as (
        select k, o.kunnr delivery_customer, second.vbtyp_v kind, second.vbelv order_id
        from ledger_columns l
        join document_flow fl on fl.vbeln = l.vbeln and fl.vbtyp_v = 'J'
             and coalesce(fl.vbtyp_n, '') <> 'X'
        join document_flow second on second.vbeln = fl.vbelv and second.vbtyp_v in ('E', 'C')
        join order_headers o on o.vbeln = second.vbelv
        where trim(l.vbeln) <> '')
    select k, delivery_customer from hops
    qualify row_number() over (partition by k
        order by case kind when 'E' then 1 when 'C' then 2 else 9 end, order_id) = 1""")
def join_flow_two_hop(f: Frames) -> DataFrame:
    items = f["ledger_columns"].where(fn.not_blank(col("vbeln"))).select("k", "vbeln")
    found = sold_to.delivery_orders(f["document_flow"], f["order_headers"])
    return items.join(found, "vbeln").select("k", "delivery_customer")


@query("join_case_key", "ledger_columns", "order_headers", sql="""
    select l.bukrs, o.bukrs_vf, count(*) n
    from (select bukrs, case when bukrs = '1082' then '0048' else bukrs end flow_company
          from ledger_columns) l
    join (select distinct bukrs_vf from order_headers) o on o.bukrs_vf = l.flow_company
    group by 1, 2""")
def join_case_key(f: Frames) -> DataFrame:
    companies = f["order_headers"].select("bukrs_vf").distinct()
    items = f["ledger_columns"].groupBy("bukrs").agg(F.count("*").alias("n"))
    key = sold_to.flow_company(col("bukrs"))
    return items.withColumn("bukrs_vf", key).join(companies, "bukrs_vf").select(
        "bukrs", "bukrs_vf", "n")


@query("join_normalised_key", "ledger_columns", "document_lines", sql="""
    select k, d.kidno, d.rebzg, d.prctr line_center
    from ledger_columns l left join document_lines d
      on l.belnr = d.belnr and l.bukrs = d.bukrs and l.gjahr = d.gjahr
     and ltrim(l.buzei, '0') = ltrim(d.buzei, '0')""")
def join_normalised_key(f: Frames) -> DataFrame:
    items = f["ledger_columns"].select("k", *invoice.ITEM)
    return invoice.with_document_lines(items, f["document_lines"]).select(
        "k", "kidno", "rebzg", "line_center")


@query("join_filtered_right", "ledger_columns", "customers", sql="""
    select k, c.industry_business_code, c.sensors_alternate_sales_territory_code territory
    from ledger_columns l left join customers c
      on c.customer_account_number = regexp_replace(l.kunnr, '^0+', '')
     and c.customer_company_code = l.bukrs and c.source_system_id = 1
     and c.customer_company_legacy_format_account_number_rank = 1
     and c.record_active_indicator = 'Y'""")
def join_filtered_right(f: Frames) -> DataFrame:
    items = f["ledger_columns"].select("k", "bukrs", fn.strip_zeros_regex(col("kunnr")).alias("plain_account"))
    return lookup_join(items, invoice.customer_facts(f["customers"]), ["plain_account", "bukrs"]
                       ).select("k", "industry_business_code",
                                col("sensors_alternate_sales_territory_code").alias("territory"))


@query("join_coalesce_key", "ledger_columns", "document_lines", "breakdown_lines", "profit_centers",
       sql="""
    select k, b.auzei, coalesce(b.prctr, d.prctr) profit_center_id, p.business_unit_id
    from ledger_columns l
    left join document_lines d on l.belnr = d.belnr and l.bukrs = d.bukrs and l.gjahr = d.gjahr
         and ltrim(l.buzei, '0') = ltrim(d.buzei, '0')
    left join breakdown_lines b on l.belnr = b.belnr and l.bukrs = b.bukrs and l.gjahr = b.gjahr
         and l.buzei = b.buzei
    left join profit_centers p on p.profit_center_id = coalesce(b.prctr, d.prctr)""")
def join_coalesce_key(f: Frames) -> DataFrame:
    items = invoice.with_document_lines(f["ledger_columns"].select("k", *invoice.ITEM),
                                        f["document_lines"])
    items = invoice.with_breakdown(items, f["breakdown_lines"]).withColumn(
        "profit_center_id", F.coalesce("part_center", "line_center"))
    return lookup_join(items.select("k", "auzei", "profit_center_id"),
                       f["profit_centers"].drop("record_active_indicator"), ["profit_center_id"])


@query("join_left_guard", "document_lines", "billing_headers", sql="""
    select d.belnr, d.buzei, d.kidno, h.knumv
    from document_lines d left join billing_headers h on h.vbeln = d.kidno
         and coalesce(d.kidno, '') <> ''""")
def join_left_guard(f: Frames) -> DataFrame:
    guarded = f["document_lines"].select("belnr", "buzei", "kidno").withColumn(
        "vbeln", F.when(fn.not_empty(col("kidno")), col("kidno")))
    return lookup_join(guarded, f["billing_headers"].select("vbeln", "knumv"), ["vbeln"]).drop("vbeln")


@query("join_multi_origin", "ledger_columns", "customers", "products", "profit_center_rules",
       "billing_lines", "materials", sql="""
    with code as (
        select vbeln, "PROD_BUSLN_FNCTN_ID" business_code
        from billing_lines b join materials m on b.matnr = m.matnr join products on prdha = "PROD_CODE"
        where "PROD_BUSLN_FNCTN_ID" <> ''
        qualify row_number() over (partition by vbeln order by abs(netwr) desc nulls last, posnr, b.matnr) = 1)
    select k, c.industry_business_code, business_code, "SAP_PROFIT_CENTER_CDE" rule_center
    from ledger_columns l
    left join customers c on c.customer_account_number = regexp_replace(l.kunnr, '^0+', '')
         and c.customer_company_code = l.bukrs and c.record_active_indicator = 'Y'
         and c.customer_company_legacy_format_account_number_rank = 1
    left join code on code.vbeln = l.vbeln
    left join profit_center_rules on "ORGANIZATION_ID" = l.bukrs
         and "INDUSTRY_BUSINESS_CDE" = c.industry_business_code
         and "COMPETENCY_BUSINESS_CDE" = business_code""")
def join_multi_origin(f: Frames) -> DataFrame:
    items = f["ledger_columns"].select("k", "bukrs", "vbeln", fn.strip_zeros_regex(col("kunnr"))
                                       .alias("plain_account"))
    items = lookup_join(items, invoice.customer_facts(f["customers"])
                        .select("plain_account", "bukrs", "industry_business_code"),
                        ["plain_account", "bukrs"])
    codes = invoice.business_codes(f["billing_lines"], f["materials"], f["products"])
    rules = f["profit_center_rules"].select(
        col("ORGANIZATION_ID").alias("bukrs"),
        col("INDUSTRY_BUSINESS_CDE").alias("industry_business_code"),
        col("COMPETENCY_BUSINESS_CDE").alias("business_code"),
        col("SAP_PROFIT_CENTER_CDE").alias("rule_center"))
    items = lookup_join(items, codes, ["vbeln"])
    return lookup_join(items, rules, ["bukrs", "industry_business_code", "business_code"]).select(
        "k", "industry_business_code", "business_code", "rule_center")


@query("join_range_validity", "ledger_columns", "budget_rates", sql=f"""
    select k, waers, cast("currency_exchange_rate_to_USD_multiplier_factor" as double) budget_rate
    from ledger_columns left join budget_rates on currency_code = waers
         and currency_exchange_rate_type_code = 1
         and {DAY} between effective_from_date and effective_to_date""")
def join_range_validity(f: Frames) -> DataFrame:
    rates = valid_on(f["budget_rates"].where("currency_exchange_rate_type_code = 1"), lit(AS_OF),
                     "effective_from_date", "effective_to_date").select(
        col("currency_code").alias("waers"),
        col("currency_exchange_rate_to_USD_multiplier_factor").alias("budget_rate"))
    return lookup_join(f["ledger_columns"].select("k", "waers"), rates, ["waers"])


@query("join_validity_dates", "items", "budget_rates", sql="""
    select k, currency, cast(doc_date as varchar) doc_date,
           cast("currency_exchange_rate_to_USD_multiplier_factor" as double) budget_rate
    from items left join budget_rates on currency_code = currency
         and currency_exchange_rate_type_code = 1
         and doc_date between effective_from_date and effective_to_date""")
def join_validity_dates(f: Frames) -> DataFrame:
    """The rate of each row's own date, where ``join_range_validity`` takes that of the run."""
    items = f["items"].select("k", "currency", "doc_date")
    span = items.agg(F.min("doc_date"), F.max("doc_date")).first()
    rates = f["budget_rates"].where("currency_exchange_rate_type_code = 1").select(
        col("currency_code").alias("currency"), "effective_from_date", "effective_to_date",
        col("currency_exchange_rate_to_USD_multiplier_factor").alias("budget_rate"))
    return validity_join(items, rates, ["currency"], "doc_date", "effective_from_date",
                         "effective_to_date", *span, ids=["k"])


@query("join_as_of", "items", "profit_center_fence", sql="""
    select k, centre, eff_date, ztedprc
    from items left join profit_center_fence on prctr = centre
         and eff_date <= replace(cast(post_date as varchar), '-', '')
    qualify row_number() over (partition by k order by eff_date desc nulls last) = 1""")
def join_as_of(f: Frames) -> DataFrame:
    items = f["items"].select("k", "centre", F.date_format("post_date", "yyyyMMdd").alias("budat"))
    hot = hot_keys(items, {"centre": ["centre"]})["centre"]
    return as_of_join(items, f["profit_center_fence"].withColumnRenamed("prctr", "centre"),
                      ["centre"], "budat", "eff_date", hot=hot).drop("budat")


@query("join_rate_on_date", "ledger_columns", "dated_rates", sql="""
    select k, waers, cast(exchange_rate as double) exchange_rate
    from (select k, waers, cast(try_strptime(case when augdt in ('', '00000000') then budat
                 else augdt end, '%Y%m%d') as date) rate_day from ledger_columns) l
    left join dated_rates on reference_date = rate_day and from_currency = waers""")
def join_rate_on_date(f: Frames) -> DataFrame:
    items = f["ledger_columns"].select(
        "k", "waers", invoice.rate_day(col("augdt"), col("budat")).alias("rate_day"))
    rates = invoice.dated_rates(f["dated_rates"]).withColumnRenamed("company_currency", "waers")
    return lookup_join(items, rates, ["rate_day", "waers"]).select("k", "waers", "exchange_rate")


@query("join_lateral_top1", "ledger_columns", "customers_current", sql="""
    select k, customer_key_id from ledger_columns l left join lateral (
        select customer_key_id from customers_current c
        where c.submitted_customer_account_number = l.kunnr and c.customer_company_code = l.bukrs
          and c.source_system_id = 1
        order by distribution_channel_code nulls first, customer_key_id limit 1) x on true""")
def join_lateral_top1(f: Frames) -> DataFrame:
    own, _ = sold_to.customer_tables(f["customers_current"])
    items = f["ledger_columns"].select("k", col("kunnr").alias("account"), col("bukrs").alias("company"))
    return lookup_join(items, own, ["account", "company"]).select("k", "customer_key_id")


@query("join_lateral_guarded", "ledger_columns", "customers_current", sql="""
    select k, bukrs, customer_key_id from ledger_columns l left join lateral (
        select customer_key_id from customers_current c
        where c.submitted_customer_account_number = l.kunnr and c.customer_company_code = '1082'
          and c.source_system_id = 1 and l.bukrs = '0048'
        order by distribution_channel_code nulls first, customer_key_id limit 1) x on true""")
def join_lateral_guarded(f: Frames) -> DataFrame:
    own, _ = sold_to.customer_tables(f["customers_current"])
    parent = own.where(col("company") == "1082").drop("company")
    items = f["ledger_columns"].select("k", "bukrs", F.when(col("bukrs") == "0048", col("kunnr"))
                                       .alias("account"))
    return lookup_join(items, parent, ["account"]).select("k", "bukrs", "customer_key_id")


@query("join_any_key_fallback", "ledger_columns", "customers_current", sql="""
    with anywhere as (
        select submitted_customer_account_number account, customer_key_id from customers_current
        where source_system_id = 1
        qualify row_number() over (partition by account order by customer_company_code,
            distribution_channel_code nulls first, customer_key_id) = 1)
    select k, kunnr, customer_key_id from ledger_columns left join anywhere on account = kunnr""")
def join_any_key_fallback(f: Frames) -> DataFrame:
    _, anywhere = sold_to.customer_tables(f["customers_current"])
    return lookup_join(f["ledger_columns"].select("k", "kunnr"),
                       anywhere.withColumnRenamed("account", "kunnr"), ["kunnr"])


@query("join_surrogate", "customers_current", "account_copies", sql="""
    select k.customer_key_id, worldwide_customer_level_1_label worldwide_customer_level_1_name,
           sales_office_label sales_office_name
    from (select c * 10 + n customer_key_id from account_copies) k
    left join customers_current using (customer_key_id)""")
def join_surrogate(f: Frames) -> DataFrame:
    keys = f["account_copies"].select((col("c") * 10 + col("n")).alias("customer_key_id"))
    return sold_to.enrich_hierarchy(keys, f["customers_current"]).select(
        "customer_key_id", "worldwide_customer_level_1_name", "sales_office_name")


@query("join_left_then_max", "document_lines", "billing_lines", sql="""
    select d.bukrs, d.belnr, d.gjahr, max(b.matnr) tariff_material
    from document_lines d left join billing_lines b on b.vbeln = d.kidno
         and b.matnr in ('1-120037-2') and b.aubel = d.vbel2 and b.aupos = d.posn2
    group by 1, 2, 3""")
def join_left_then_max(f: Frames) -> DataFrame:
    documents = f["document_lines"].select(*sold_to.DOCUMENT).distinct()
    flagged = invoice.tariff_documents(f["document_lines"], f["billing_lines"])
    return lookup_join(documents, flagged, sold_to.DOCUMENT, spread=False)


@query("join_role_playing", "ledger_columns", "companies", "currency_decimals", sql="""
    select k, l.waers, d.currdec document_decimals, c.waers company_currency,
           t.currdec company_decimals
    from ledger_columns l left join currency_decimals d on d.currkey = l.waers
    left join companies c using (bukrs) left join currency_decimals t on t.currkey = c.waers""")
def join_role_playing(f: Frames) -> DataFrame:
    decimals = f["currency_decimals"]
    items = lookup_join(f["ledger_columns"].select("k", "bukrs", "waers"), decimals.select(
        col("currkey").alias("waers"), col("currdec").alias("document_decimals")), ["waers"])
    items = lookup_join(items, f["companies"].withColumnRenamed("waers", "company_currency"), ["bukrs"])
    return lookup_join(items, decimals.select(
        col("currkey").alias("company_currency"), col("currdec").alias("company_decimals")),
        ["company_currency"]).drop("bukrs")


@query("join_override_key", "document_lines", "profit_centers", "business_units", sql="""
    with own as (
        select d.belnr, d.buzei, d.prctr, case when p.business_unit_id in ('LGL', 'TMP', 'CRP')
               then null else d.prctr end final_center
        from document_lines d left join profit_centers p on p.profit_center_id = d.prctr)
    select belnr, buzei, prctr, final_center, u.business_unit_group_id
    from own left join profit_centers p on p.profit_center_id = final_center
    left join business_units u on u.business_unit_id = p.business_unit_id""")
def join_override_key(f: Frames) -> DataFrame:
    units = invoice.profit_center_units(f["profit_centers"], f["business_units"])
    lines = f["document_lines"].select("belnr", "buzei", "prctr")
    lines = lookup_join(lines, units.select(col("profit_center_id").alias("prctr"),
                                            "business_unit_id"), ["prctr"])
    lines = lines.withColumn("final_center", invoice.profit_center_override(
        lit(None).cast("string"), col("business_unit_id"), col("prctr"), lit(None).cast("string")))
    return lookup_join(lines, units.select(col("profit_center_id").alias("final_center"),
                                           "business_unit_group_id"), ["final_center"]).drop(
        "business_unit_id")


@query("join_fanout", "ledger_columns", "billing_lines", sql="""
    select k, l.vbeln, b.posnr, b.matnr, cast(b.netwr as double) netwr
    from ledger_columns l join billing_lines b on b.vbeln = l.vbeln""")
def join_fanout(f: Frames) -> DataFrame:
    items = f["ledger_columns"].select("k", "vbeln")
    lines = f["billing_lines"].select("vbeln", "posnr", "matnr", "netwr")
    hot = [hot_keys(df, {"d": ["vbeln"]})["d"] for df in (items, lines)]
    return fan_out(items, lines, ["vbeln"], hot_grid(items, *hot))


@query("join_own_aggregate", "billing_lines", sql="""
    select b.vbeln, b.posnr, b.matnr, cast(netwr as double) netwr, cast(total as double) total, lines
    from billing_lines b join (select vbeln, sum(netwr) total, count(posnr) lines
                               from billing_lines group by vbeln) t on t.vbeln = b.vbeln""")
def join_own_aggregate(f: Frames) -> DataFrame:
    lines = f["billing_lines"].select("vbeln", "posnr", "matnr", "netwr")
    hot = hot_keys(lines, {"d": ["vbeln"]})["d"]
    return lookup_join(lines, group_totals(lines, "vbeln", "netwr", "posnr"), ["vbeln"], hot=hot)


@query("join_scalar_compare", "open_items", "cleared_items", sql="""
    select (select count(*) from open_items) open_rows, (select count(*) from cleared_items) cleared_rows,
           (select cast(coalesce(sum(wrbtr), 0) as double) from open_items) open_sum,
           (select cast(coalesce(sum(wrbtr), 0) as double) from cleared_items) cleared_sum""")
def join_scalar_compare(f: Frames) -> DataFrame:
    both = ledger_items(f["open_items"], f["cleared_items"])

    def side(status: str):
        is_mine = col("item_status") == status
        mine = F.when(is_mine, col("wrbtr"))
        return (F.count_if(is_mine).alias(f"{status.lower()}_rows"),
                F.coalesce(F.sum(mine), lit(0)).alias(f"{status.lower()}_sum"))
    return both.agg(*side("OPEN"), *side("CLEARED"))


@query("join_calendar", "snapshot", "orders", sql="""
    with calendar as (select distinct cast(o_orderdate as date) as calendar_date,
                             year(o_orderdate) fiscal_year, month(o_orderdate) fiscal_month from orders)
    select fiscal_year, fiscal_month, snapshot_state, count(*) n
    from snapshot join calendar on calendar_date = snapshot_date group by 1, 2, 3""")
def join_calendar(f: Frames) -> DataFrame:
    day = F.to_date("o_orderdate")
    calendar = f["orders"].select(day.alias("snapshot_date"), F.year(day).alias("fiscal_year"),
                                  F.month(day).alias("fiscal_month")).distinct()
    daily = f["snapshot"].groupBy("snapshot_date", "snapshot_state").agg(F.count("*").alias("n"))
    return (daily.join(calendar, "snapshot_date")
            .groupBy("fiscal_year", "fiscal_month", "snapshot_state").agg(F.sum("n").alias("n")))


# --- aggregates ---------------------------------------------------------------------------

@query("agg_max_cast", "payment_terms", sql="""
    select zterm, max(try_cast(ztag1 as integer)) terms_days from payment_terms group by zterm""")
def agg_max_cast(f: Frames) -> DataFrame:
    return invoice.payment_terms(f["payment_terms"])


@query("agg_distinct_concat", "billing_lines", sql="""
    select vbeln, array_to_string(list_sort(list_distinct(list(matnr))), ', ') material_number
    from billing_lines group by vbeln""")
def agg_distinct_concat(f: Frames) -> DataFrame:
    lines = f["billing_lines"].select("vbeln", "matnr").distinct()
    return lines.groupBy("vbeln").agg(
        F.concat_ws(", ", F.sort_array(F.collect_set("matnr"))).alias("material_number"))


@query("agg_max_flag", "document_lines", sql="""
    select bukrs, belnr, gjahr, max(case when trim(kunnr) <> '' then kunnr end) customer
    from document_lines group by 1, 2, 3""")
def agg_max_flag(f: Frames) -> DataFrame:
    return f["document_lines"].groupBy(*sold_to.DOCUMENT).agg(
        F.max(F.when(fn.not_blank(col("kunnr")), col("kunnr"))).alias("customer"))


@query("agg_filtered_max", "price_conditions", sql="""
    select knumv, cast(max(kbetr) as double) tariff_value from price_conditions
    where kschl in ('ZTRF', 'ZTRM') group by knumv""")
def agg_filtered_max(f: Frames) -> DataFrame:
    return invoice.tariff_conditions(f["price_conditions"])


@query("agg_doc_totals", "billing_lines", sql="""
    select vbeln, cast(sum(netwr) as double) total, count(posnr) lines from billing_lines
    where trim(matnr) <> '' group by vbeln""")
def agg_doc_totals(f: Frames) -> DataFrame:
    return group_totals(f["billing_lines"].where(fn.not_blank(col("matnr"))), "vbeln", "netwr", "posnr")


@query("agg_count", "snapshot", sql=f"select count(*) n from snapshot where snapshot_date = {DAY}")
def agg_count(f: Frames) -> DataFrame:
    return f["snapshot"].where(col("snapshot_date") == lit(AS_OF)).agg(F.count("*").alias("n"))


@query("agg_sum_or_zero", "snapshot", sql=f"""
    select cast(coalesce(sum(material_open_functional_amount), 0) as double) open_sum,
           cast(coalesce(sum(case when snapshot_state = 'NONE' then money end), 0) as double) no_sum
    from snapshot where snapshot_date = {DAY} and snapshot_state = 'OPEN'""")
def agg_sum_or_zero(f: Frames) -> DataFrame:
    rows = f["snapshot"].where((col("snapshot_date") == lit(AS_OF)) & (col("snapshot_state") == "OPEN"))
    none = F.when(col("snapshot_state") == "NONE", col("money"))
    return rows.agg(F.coalesce(F.sum("material_open_functional_amount"), lit(0)).alias("open_sum"),
                    F.coalesce(F.sum(none), lit(0)).alias("no_sum"))


@query("agg_offenders", "snapshot", sql="""
    select count(*) n, min(accounting_document_id) first_document, max(material_number) last_material,
           cast(max(abs(material_open_functional_amount - (material_current_due_functional_amount
             + material_past_due_functional_amount + material_disputed_functional_amount))) as double) gap
    from snapshot where abs(material_open_functional_amount - (material_current_due_functional_amount
             + material_past_due_functional_amount + material_disputed_functional_amount)) > 0.01""")
def agg_offenders(f: Frames) -> DataFrame:
    return f["snapshot"].where(bucket_gap() > 0.01).agg(
        F.count("*").alias("n"), F.min("accounting_document_id").alias("first_document"),
        F.max("material_number").alias("last_material"), F.max(bucket_gap()).alias("gap"))


@query("agg_duplicates", "lineitem", sql="""
    select count(*) repeated_keys, min(l_orderkey) first_key, max(n) most
    from (select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1) x""")
def agg_duplicates(f: Frames) -> DataFrame:
    copies = f["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return copies.where("n > 1").agg(F.count("*").alias("repeated_keys"),
                                     F.min("l_orderkey").alias("first_key"), F.max("n").alias("most"))


@query("agg_count_by", "snapshot", sql="""
    select cast(snapshot_date as varchar) snapshot_date, snapshot_state, count(*) n
    from snapshot group by 1, 2""")
def agg_count_by(f: Frames) -> DataFrame:
    return f["snapshot"].groupBy("snapshot_date", "snapshot_state").agg(F.count("*").alias("n"))


# --- first row per group ------------------------------------------------------------------

@query("win_largest_line", "billing_lines", sql="""
    select vbeln, posnr, matnr, cast(netwr as double) netwr from billing_lines
    qualify row_number() over (partition by vbeln order by abs(netwr) desc nulls last, posnr, matnr) = 1""")
def win_largest_line(f: Frames) -> DataFrame:
    return top1(f["billing_lines"].select("vbeln", "posnr", "matnr", "netwr"), ["vbeln"],
                [F.abs("netwr").desc(), col("posnr"), col("matnr")])


@query("win_first_predecessor", "document_flow", sql="""
    select vbeln, min(vbelv) vbelv from document_flow group by vbeln""")
def win_first_predecessor(f: Frames) -> DataFrame:
    return top1(f["document_flow"].select("vbeln", "vbelv"), ["vbeln"], [col("vbelv")])


@query("win_case_priority", "document_flow", sql="""
    select distinct on (vbeln) vbeln, vbelv, vbtyp_v from document_flow
    order by vbeln, case vbtyp_v when 'E' then 1 when 'C' then 2 else 9 end, vbelv, vbtyp_v""")
def win_case_priority(f: Frames) -> DataFrame:
    kind = col("vbtyp_v")
    rank = F.when(kind == "E", 1).when(kind == "C", 2).otherwise(9)
    return top1(f["document_flow"].select("vbeln", "vbelv", "vbtyp_v"), ["vbeln"],
                [rank, col("vbelv"), kind])


@query("win_first_item", "document_lines", sql="""
    select bukrs, belnr, gjahr, arg_min(kunnr, buzei) first_customer from document_lines
    where koart = 'D' and trim(kunnr) <> '' and bukrs = '0048' group by 1, 2, 3""")
def win_first_item(f: Frames) -> DataFrame:
    return sold_to.first_customer(f["document_lines"])


@query("win_dedupe_dim", "customers_current", sql="""
    select distinct on (submitted_customer_account_number, customer_company_code)
           submitted_customer_account_number account, customer_company_code company, customer_key_id
    from customers_current where source_system_id = 1
    order by submitted_customer_account_number, customer_company_code,
             distribution_channel_code nulls first, customer_key_id""")
def win_dedupe_dim(f: Frames) -> DataFrame:
    return sold_to.customer_tables(f["customers_current"])[0]


@query("win_latest_then_status", "open_items", "cleared_items", "ledger", "profit_center_fence",
       sql="""
    with both_ledgers as (select *, 'OPEN' item_status from open_items
                          union all select *, 'CLEARED' from cleared_items)
    select b.bukrs, b.belnr, b.buzei, b.budat, item_status, eff_date
    from both_ledgers b join ledger using (k)
    left join profit_center_fence on prctr = segment and eff_date <= b.budat
    qualify row_number() over (partition by b.bukrs, b.kunnr, b.belnr, b.gjahr, b.buzei
        order by eff_date desc nulls last, case item_status when 'CLEARED' then 1 else 2 end) = 1""")
def win_latest_then_status(f: Frames) -> DataFrame:
    segments = f["ledger"].select("belnr", col("segment").alias("profit_center_id"))
    items = ledger_items(f["open_items"], f["cleared_items"]).join(segments, "belnr")
    items = invoice.with_fence(items, f["profit_center_fence"]).withColumn("auzei", lit(None).cast("int"))
    return invoice.one_per_item(items).select("bukrs", "belnr", "buzei", "budat", "item_status",
                                              "eff_date")


# --- sorts, limits, unions ------------------------------------------------------------------

@query("sort_report", "snapshot", sql=f"""
    select cast(snapshot_date as varchar) snapshot_date, count(*) as "rows" from snapshot
    where snapshot_date >= {DAY} - 60 and snapshot_date < {DAY} group by 1 order by 1""")
def sort_report(f: Frames) -> DataFrame:
    kept = snapshot.retain(f["snapshot"], AS_OF)
    return kept.groupBy("snapshot_date").agg(F.count("*").alias("rows")).orderBy("snapshot_date")


@query("limit_rows", "snapshot", sql=f"""
    select accounting_document_id, billing_document_item_id, material_number,
           cast(money as double) amount
    from snapshot where snapshot_date < {DAY} - 60 order by 1, 2, 3, 4 limit 100""")
def limit_rows(f: Frames) -> DataFrame:
    stale = snapshot.stale(f["snapshot"], AS_OF).select(
        "accounting_document_id", "billing_document_item_id", "material_number",
        col("money").alias("amount"))
    return stale.orderBy(*stale.columns).limit(100)


@query("union_status", "open_items", "cleared_items", sql="""
    select belnr, buzei, budat, cast(wrbtr as double) wrbtr, 'OPEN' item_status from open_items
    union all select belnr, buzei, budat, cast(wrbtr as double), 'CLEARED' from cleared_items""")
def union_status(f: Frames) -> DataFrame:
    return ledger_items(f["open_items"], f["cleared_items"]).select(
        "belnr", "buzei", "budat", "wrbtr", "item_status")


@query("union_checks", "snapshot", sql=f"""
    select 'old' check_id, count(*) n from snapshot where snapshot_date < {DAY} - 60 having count(*) > 0
    union all select 'future', count(*) from snapshot where snapshot_date > {DAY} having count(*) > 0
    union all select 'today', count(*) from snapshot where snapshot_date = {DAY} having count(*) > 0""")
def union_checks(f: Frames) -> DataFrame:
    """One counter per rule in a single pass; rules that nothing breaks give no row."""
    day = col("snapshot_date")
    rules = {"old": day < F.date_sub(lit(AS_OF), 60), "future": day > lit(AS_OF), "today": day == lit(AS_OF)}
    counted = f["snapshot"].agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = ", ".join(f"'{name}', {name}" for name in rules)
    return counted.selectExpr(f"stack({len(rules)}, {pairs}) as (check_id, n)").where("n > 0")
