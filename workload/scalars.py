"""Scalar functions over the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from duebook import functions as fn

from .frames import AS_OF, Frames
from .registry import query

col, lit = F.col, F.lit


def _apply(key: str, frame: str, sql_value: str, value: Callable[[], Column], keys: tuple[str, ...] = ("k",)):
    names = ", ".join(keys)

    @query(key, frame, sql=f"select {names}, {sql_value} as value from {frame}")
    def run(f: Frames) -> DataFrame:
        return f[frame].select(*keys, value().alias("value"))




def _line(key: str, sql_value: str, value: Callable[[], Column]):
    @query(key, "billing_lines", sql=f"""
        select vbeln, posnr, cast(kzwi1 as double) gross, {sql_value} as value from billing_lines""")
    def run(f: Frames) -> DataFrame:
        return f["billing_lines"].select("vbeln", "posnr", col("kzwi1").alias("gross"),
                                         value().alias("value"))


_line("fn_strip_zeros", "ltrim(matnr, '0')", lambda: fn.strip_zeros(col("matnr")))
_line("fn_regexp_strip", "regexp_replace(matnr, '^0+', '')", lambda: fn.strip_zeros_regex(col("matnr")))
_line("fn_trim", "trim(matnr)", lambda: F.trim("matnr"))
_line("fn_blank_to_null", "nullif(trim(matnr), '')", lambda: fn.blank_to_null(col("matnr")))
_apply("fn_length", "ledger_columns", "length(rstgr)", lambda: F.length("rstgr"))
_apply("fn_concat_detail", "ledger_columns",
       "'doc=' || belnr || ', year=' || gjahr || ', amount=' || cast(wrbtr as varchar)",
       lambda: F.concat(lit("doc="), col("belnr"), lit(", year="), col("gjahr"), lit(", amount="),
                col("wrbtr").cast("string")))
_apply("fn_coalesce_chain", "ledger_columns", "coalesce(nullif(zbd3t, '0'), nullif(zbd2t, '0'), nullif(zbd1t, ''), rstgr, '-')",
       lambda: F.coalesce(F.nullif(col("zbd3t"), lit("0")), F.nullif(col("zbd2t"), lit("0")),
                  F.nullif(col("zbd1t"), lit("")), col("rstgr"), lit("-")))
_apply("fn_zero_to_null", "ledger_columns", "nullif(try_cast(zbd3t as integer), 0)",
       lambda: fn.zero_to_null(fn.to_int(col("zbd3t"))))
_apply("fn_nullif_mixed", "ledger_columns",
       "coalesce(case when try_cast(augdt as integer) = 0 or augdt = '' then null else augdt end, budat)",
       lambda: F.coalesce(F.when(fn.zero_to_null(fn.to_int(col("augdt"))).isNotNull(), col("augdt")),
                  col("budat")))
_apply("fn_if", "ledger_columns", "case when zfbdt is null or zfbdt in ('', '00000000') then bldat else zfbdt end",
       lambda: F.when(F.coalesce(col("zfbdt"), lit("")).isin("", "00000000"), col("bldat"))
       .otherwise(col("zfbdt")))
_apply("fn_case", "items", """case when status = 'OPEN' and reason = '01' then 'disputed'
       when status = 'OPEN' and due_date >= date '2001-06-30' then 'current'
       when status = 'OPEN' then 'past' else 'cleared' end""",
       lambda: F.when((col("status") == "OPEN") & (col("reason") == "01"), "disputed")
       .when((col("status") == "OPEN") & (col("due_date") >= lit(AS_OF)), "current")
       .when(col("status") == "OPEN", "past").otherwise("cleared"))
_apply("fn_try_cast", "ledger_columns", "try_cast(zbd2t as integer)", lambda: fn.to_int(col("zbd2t")))
_apply("fn_cast_decimal", "ledger_columns", "cast(cast(wrbtr as decimal(36,3)) as double)",
       lambda: col("wrbtr").cast("decimal(36,3)"))


@query("fn_cast_misc", "ledger_columns", sql="""
    select k, cast(cast(substr(bldat, 1, 4) || '-' || substr(bldat, 5, 2) || '-01' as date) as varchar)
                  first_day,
           cast(gjahr as bigint) fiscal_year, cast(wrbtr as varchar) amount_text
    from ledger_columns""")
def casts(f: Frames) -> DataFrame:
    day = F.concat(F.substring("bldat", 1, 4), lit("-"), F.substring("bldat", 5, 2), lit("-01"))
    return f["ledger_columns"].select(
        "k", day.cast("date").alias("first_day"), col("gjahr").cast("long").alias("fiscal_year"),
        col("wrbtr").cast("string").alias("amount_text"))


_apply("fn_round", "ledger_columns", "round(cast(wrbtr as double), 1)",
       lambda: F.round(col("wrbtr").cast("double"), 1))


@query("fn_currency_scale", "currency_decimals", "ledger_columns", sql="""
    select k, waers, power(10, 2 - coalesce(currdec, 2)) as value
    from ledger_columns left join currency_decimals on currkey = waers""")
def currency_scale(f: Frames) -> DataFrame:
    decimals = f["currency_decimals"].withColumnRenamed("currkey", "waers")
    return (f["ledger_columns"].join(decimals, "waers", "left")
            .select("k", "waers", fn.currency_scale(col("currdec")).alias("value")))


_apply("fn_abs", "billing_lines", "cast(abs(netwr) as double)", lambda: F.abs("netwr"),
       ("vbeln", "posnr", "matnr"))


@query("fn_arith", "items", sql="""
    select k, cast(amount as double) * 1.5 times, cast(amount as double) / 4 fourth,
           cast(amount + 1 as double) plus, cast(amount - 1 as double) minus
    from items""")
def arithmetic(f: Frames) -> DataFrame:
    amount = col("amount").cast("double")
    return f["items"].select("k", (amount * 1.5).alias("times"),
                             (amount / 4).alias("fourth"),
                             (col("amount") + 1).alias("plus"), (col("amount") - 1).alias("minus"))


_apply("fn_date_add", "items", "cast(cast(doc_date + cast(term_days as int) as date) as varchar)",
       lambda: F.date_add("doc_date", col("term_days").cast("int")))
_apply("fn_date_sub", "items", "cast(cast(doc_date - 60 as date) as varchar)",
       lambda: F.date_sub("doc_date", 60))
_apply("fn_to_date", "orders", "cast(cast(o_orderdate as date) as varchar)",
       lambda: F.to_date("o_orderdate"), ("o_orderkey",))


# The fifth id, of the business unit, is that of the account's company here.
_FIVE = """[coalesce(customer_owning_business_unit_dsg_id, 0),
             coalesce(sales_territory_owning_business_unit_dsg_id, 0),
             coalesce(gam_global_business_unit_owning_business_unit_dsg_id, 0),
             coalesce(company_dsg_id, 0), coalesce(business_unit_dsg_id, 0)]"""
_OWNED = f"""owned as (
        select c.*, company_dsg_id, business_unit_dsg_id from customers c
        left join company_dim on company_code = customer_company_code and company_dim.record_active_indicator = 'Y'
        left join profit_centers p on p.profit_center_id = industry_business_code
        left join business_units using (business_unit_id))"""


def _owned(f: Frames) -> tuple[DataFrame, list]:
    """Customers with the ids of all five owning units, null where there is none."""
    companies = f["company_dim"].where("record_active_indicator = 'Y'").select(
        col("company_code").alias("customer_company_code"), "company_dsg_id")
    units = f["profit_centers"].join(f["business_units"], "business_unit_id").select(
        col("profit_center_id").alias("industry_business_code"), "business_unit_dsg_id")
    rows = f["customers"].join(companies, "customer_company_code", "left").join(
        units, "industry_business_code", "left")
    return rows, [col(c) for c in (
        "customer_owning_business_unit_dsg_id", "sales_territory_owning_business_unit_dsg_id",
        "gam_global_business_unit_owning_business_unit_dsg_id", "company_dsg_id", "business_unit_dsg_id")]


@query("fn_array_ids", "customers", "company_dim", "profit_centers", "business_units", sql=f"""
    with {_OWNED}
    select customer_account_number, customer_company_legacy_format_account_number_rank acct_rank,
           array_to_string({_FIVE}, ',') ids from owned""")
def array_of_ids(f: Frames) -> DataFrame:
    rows, ids = _owned(f)
    return rows.select(
        "customer_account_number",
        col("customer_company_legacy_format_account_number_rank").alias("acct_rank"),
        F.concat_ws(",", F.array(*[F.coalesce(c, lit(0)) for c in ids]).cast("array<string>")).alias("ids"))


_apply("fn_mixed_compare", "items", "coalesce(breakdown, 1) = 1",
       lambda: F.coalesce(fn.to_int(col("breakdown").cast("string")), lit(1)) == 1)


# --- functions whose meaning is assumed ---------------------------------------------------

@query("udf_parse_date", "ledger_columns", sql="""
    select k, cast(cast(try_strptime(nullif(nullif(zfbdt, ''), '00000000'), '%Y%m%d') as date) as varchar)
                  baseline,
           cast(cast(try_strptime(nullif(nullif(augdt, ''), '00000000'), '%Y%m%d') as date) as varchar)
                  clearing
    from ledger_columns""")
def parse_dates(f: Frames) -> DataFrame:
    return f["ledger_columns"].select("k", fn.parse_yyyymmdd(col("zfbdt")).alias("baseline"),
                                      fn.parse_yyyymmdd(col("augdt")).alias("clearing"))


_apply("udf_signed_amount", "ledger_columns",
       "cast(case when shkzg = 'H' then -round(wrbtr, 3) else round(wrbtr, 3) end as double)",
       lambda: fn.signed_amount(col("wrbtr"), col("shkzg")))


@query("udf_convert_currency", "ledger_columns", "dated_rates", sql="""
    select k, cast(wrbtr as double) * cast(exchange_rate as double)
               * cast(target_currency_ratio as double) / cast(from_currency_ratio as double) as value
    from ledger_columns
    left join dated_rates on replace(cast(reference_date as varchar), '-', '') = budat
         and from_currency = waers""")
def convert_currency(f: Frames) -> DataFrame:
    rates = f["dated_rates"].withColumn("budat", F.date_format("reference_date", "yyyyMMdd"))
    rates = rates.withColumnRenamed("from_currency", "waers").drop("reference_date")
    value = fn.convert_amount(col("wrbtr"), col("exchange_rate"), col("from_currency_ratio"),
                              col("target_currency_ratio"))
    return (f["ledger_columns"].join(rates, ["budat", "waers"], "left")
            .select("k", value.alias("value")))


@query("udf_security_tag", "customers", "company_dim", "profit_centers", "business_units",
       "security_tags", sql=f"""
    with {_OWNED},
    keyed as (
        select customer_account_number acct, customer_company_legacy_format_account_number_rank acct_rank,
               array_to_string(list_sort(list_distinct({_FIVE})), '-') security_key
        from owned)
    select acct, acct_rank, security_key, coalesce(security_tag, 'NONE') security_tag
    from keyed left join security_tags using (security_key)""")
def security_tag(f: Frames) -> DataFrame:
    from duebook.plans.invoice import with_security_tag
    rows, ids = _owned(f)
    keyed = rows.select(
        col("customer_account_number").alias("acct"),
        col("customer_company_legacy_format_account_number_rank").alias("acct_rank"),
        fn.security_key(*ids).alias("security_key"))
    return with_security_tag(keyed, f["security_tags"], "NONE")
