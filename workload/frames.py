"""Receivables tables derived from the test tables.

One SQL text per table in the dialect that Spark and DuckDB share, so that both engines
start from the same input; ``{name}`` stands for another table.  The operators under test
are written separately: as DataFrames on the Spark side, as SQL on the other.
"""

from __future__ import annotations

import datetime as dt
import re
from concurrent.futures import ThreadPoolExecutor
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from duebook.session import released_shuffles, shared_folder

AS_OF = dt.date(2001, 6, 30)

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

_YMD = "replace(cast({} as string), '-', '')"
_COMPANY = ("case when {0} % 5 = 0 then '0048' when {0} % 5 = 1 then '1082' "
            "else lpad(cast({0} as string), 4, '0') end")
_CURRENCY = ("case when {0} % 5 < 2 then 'USD' when {0} % 4 = 0 then 'JPY' "
             "when {0} % 4 = 1 then 'KWD' else 'EUR' end")


def _id(column: str, width: int = 10) -> str:
    return f"lpad(cast({column} as string), {width}, '0')"


FRAMES: dict[str, str] = {
    # One row per order, with everything the ledger tables are cut from.
    "ledger": f"""
        select o_orderkey k, o_custkey c, c_mktsegment segment, o_orderstatus status,
               {_COMPANY.format("c_nationkey")} bukrs, {_CURRENCY.format("c_nationkey")} waers,
               {_id("o_custkey")} kunnr, {_id("o_orderkey")} belnr,
               cast(year(o_orderdate) as string) gjahr,
               {_id("1 + o_orderkey % 3", 3)} buzei, cast(1 + o_orderkey % 3 as string) item_no,
               cast(o_orderdate as date) doc_day,
               cast(o_orderdate as date) + cast(o_orderkey % 5 as int) posted,
               case when o_orderstatus = 'F' then last_day(cast(o_orderdate as date)) end cleared,
               substr(o_orderpriority, 1, 1) priority, o_orderpriority,
               cast(o_totalprice as decimal(18,2)) amount
        from {{orders}} join {{customer}} on o_custkey = c_custkey""",
    "ledger_columns": f"""
        select bukrs, kunnr, belnr, gjahr, buzei,
               case when k % 7 = 0 then 'DG' else 'RV' end blart,
               {_YMD.format("doc_day")} bldat, {_YMD.format("posted")} budat,
               case when status = 'F' then {_id("k + 900000")} else '' end augbl,
               case when status = 'F' then {_YMD.format("cleared")}
                    when k % 2 = 0 then '00000000' else '' end augdt,
               case when k % 11 = 0 then 'H' else 'S' end shkzg,
               case when k % 10 = 0 then 'X' else '' end xzahl,
               case when k % 13 = 0 then '' when k % 13 = 1 then '  ' else belnr end vbeln,
               'item ' || o_orderpriority sgtxt,
               case when k % 4 = 0 then '' when k % 4 = 1 then '00000000'
                    else {_YMD.format("doc_day")} end zfbdt,
               'Z' || priority zterm,
               case when k % 6 = 2 then '14' else '' end zbd1t,
               case when k % 6 = 1 then '30' when k % 6 = 3 then 'n/a' else '0' end zbd2t,
               case when k % 6 = 0 then '45' else '0' end zbd3t,
               waers, amount wrbtr, cast(amount + 1 as decimal(18,2)) dmbtr,
               case when status = 'P' then '01' when k % 5 = 0 then null
                    when k % 17 = 0 then 'ABC' else '' end rstgr,
               '0000140000' saknr, status, k
        from {{ledger}}""",
    "cleared_items": "select * from {ledger_columns} where status = 'F'",
    # Some cleared items are still in the open ledger, a few of them posted later.
    "open_items": f"""
        select bukrs, kunnr, belnr, gjahr, buzei, blart, bldat,
               case when k % 58 = 0 and status = 'F' then '20011231' else budat end budat,
               case when status = 'F' then '' else augbl end augbl,
               case when status = 'F' then '' else augdt end augdt,
               shkzg, xzahl, vbeln, sgtxt, zfbdt, zterm, zbd1t, zbd2t, zbd3t, waers, wrbtr,
               dmbtr, rstgr, saknr, status, k
        from {{ledger_columns}} where status <> 'F' or k % 29 = 0""",
    "document_lines": f"""
        select belnr, bukrs, gjahr, item_no buzei,
               case when k % 13 = 0 then '' when k % 13 = 1 then null else belnr end kidno,
               belnr vbel2, '1' posn2, 'D' koart,
               case when k % 19 = 0 then ' ' else {_id("c + 1")} end kunnr,
               case when k % 2 = 0 then '' else 'R1' end rebzg,
               case when k % 23 = 0 then null when k % 31 = 0 then 'PLACEHOLDER' else segment end prctr
        from {{ledger}}
        union all
        select belnr, bukrs, gjahr, '9', null, null, null,
               case when k % 3 = 0 then 'D' else 'S' end, {_id("c + 7")}, '', 'MACHINERY'
        from {{ledger}} where k % 4 = 0""",
    "document_headers": """
        select bukrs, belnr, gjahr, 'U' || cast(c % 10 as string) usnam
        from {ledger} where k % 31 <> 0""",
    "breakdown_lines": """
        select bukrs, belnr, gjahr, buzei, 1 auzei, 'S' shkzg,
               case when k % 8 = 0 then null else 'FURNITURE' end prctr,
               cast(amount - 100 as decimal(18,2)) dmbtr
        from {ledger} where k % 4 = 0
        union all
        select bukrs, belnr, gjahr, buzei, 2, 'H', segment,
               case when k % 3 = 0 then null else cast(100 as decimal(18,2)) end
        from {ledger} where k % 4 = 0""",
    "billing_lines": f"""
        select {_id("l_orderkey")} vbeln, {_id("l_linenumber", 6)} posnr,
               case when l_partkey % 40 = 0 then ' ' when l_partkey % 97 = 0 then '1-120037-2'
                    else {_id("l_partkey", 18)} end matnr,
               case when l_partkey % 7 = 0 then null else 'line ' || l_returnflag end arktx,
               cast(l_quantity as decimal(18,3)) lmeng, 'EA' meins,
               cast(case when l_orderkey % 37 = 0 then 0 when l_orderkey % 41 = 0 then -l_extendedprice
                    else l_extendedprice end as decimal(18,2)) netwr,
               cast(l_extendedprice as decimal(18,2)) kzwi1,
               {_id("l_orderkey")} aubel, cast(l_linenumber as string) aupos
        from {{lineitem}}""",
    "billing_headers": f"""
        select {_id("o_orderkey")} vbeln,
               case when o_orderkey % 3 = 0 then ' ' when o_orderkey % 3 = 1 then {_id("o_custkey + 2")}
               end kunag, 'K' || cast(o_orderkey as string) knumv
        from {{orders}} where o_orderkey % 43 <> 0""",
    "price_conditions": """
        select 'K' || cast(l_orderkey as string) knumv,
               case l_linenumber when 1 then 'ZTRF' when 2 then 'ZTRM' else 'ZPR0' end kschl,
               cast(case when l_orderkey % 18 = 0 then null else l_quantity end as decimal(18,2)) kbetr
        from {lineitem} where l_orderkey % 9 = 0""",
    "document_flow": f"""
        select {_id("l_orderkey")} vbeln,
               case when l_returnflag = 'N' then 'D' || {_id("l_suppkey", 9)}
                    else {_id("l_suppkey")} end vbelv,
               case l_returnflag when 'N' then 'J' when 'A' then 'C' else 'X' end vbtyp_v,
               case when l_linestatus = 'O' then 'M' when l_quantity > 25 then 'X' end vbtyp_n
        from {{lineitem}}
        union all
        select 'D' || {_id("s_suppkey", 9)}, {_id("s_suppkey")},
               case when s_suppkey % 3 = 0 then 'E' else 'C' end, 'J'
        from {{supplier}} where s_suppkey % 4 <> 0
        union all
        select 'D' || {_id("s_suppkey", 9)}, {_id("s_suppkey + 1")}, 'E', 'J'
        from {{supplier}} where s_suppkey % 2 = 0""",
    "order_headers": f"""
        select {_id("s_suppkey")} vbeln,
               case when s_suppkey % 9 = 0 then null else {_id("s_suppkey * 3 + 5")} end kunnr,
               {_COMPANY.format("s_nationkey")} bukrs_vf
        from {{supplier}}""",
    "payment_terms": """
        select distinct 'Z' || priority zterm,
               cast(30 * cast(priority as int) as string) ztag1
        from {ledger} where priority <> '3'
        union all
        select distinct 'Z' || priority, 'none' from {ledger}""",
    "companies": f"""
        select {_COMPANY.format("n_nationkey")} bukrs, max({_CURRENCY.format("n_nationkey")}) waers
        from {{nation}} where n_nationkey <> 7 group by 1""",
    "currency_decimals": f"""
        select currkey, case currkey when 'JPY' then 0 when 'KWD' then 3 else 2 end currdec
        from (select distinct {_CURRENCY.format("n_nationkey")} currkey from {{nation}}) x
        where currkey <> 'EUR'""",
    "dated_rates": """
        select distinct r.rate_day reference_date, w from_currency,
               cast(1 + month(r.rate_day) as decimal(18,4)) exchange_rate,
               cast(case when w = 'KWD' then 10 else 1 end as decimal(18,4)) from_currency_ratio,
               cast(case when w = 'JPY' then 100 else 1 end as decimal(18,4)) target_currency_ratio
        from (select distinct coalesce(cleared, posted) rate_day, waers w from {ledger}) r
        where year(r.rate_day) >= 1995""",
    "rate_years": """
        select distinct waers, cast(year(doc_day) as int) y from {ledger} where waers <> 'EUR'""",
    "budget_rates": """
        select waers currency_code, cast(code as int) currency_exchange_rate_type_code,
               make_date(y, 1, 1) effective_from_date, make_date(y, 12, 31) effective_to_date,
               cast(code + (y - 1995) * 0.05 as decimal(18,4))
                   "currency_exchange_rate_to_USD_multiplier_factor"
        from (select *, 1 code from {rate_years} union all select *, 2 from {rate_years}) x""",
    "profit_center_fence": """
        select distinct segment prctr, cast(year(doc_day) as string) || '0401' eff_date,
               'T' || substr(segment, 1, 3) || cast(year(doc_day) as string) ztedprc
        from {ledger}""",
    "materials": f"""
        select {_id("p_partkey", 18)} matnr, p_brand prdha from {{part}}""",
    "products": """
        select distinct p_brand "PROD_CODE",
               case when p_brand like '%3' then '' when p_brand like '%4' then null
                    else 'F' || substr(p_brand, 7, 1) end "PROD_BUSLN_FNCTN_ID"
        from {part}""",
    "ruled": """
        select distinct bukrs, segment from {ledger} where segment <> 'BUILDING'""",
    "profit_center_rules": """
        select bukrs "ORGANIZATION_ID", segment "INDUSTRY_BUSINESS_CDE",
               code "COMPETENCY_BUSINESS_CDE",
               'A' || substr(segment, 1, 2) "MGE_PROFIT_CENTER_ABBREV_ID",
               'PC' || substr(segment, 1, 2) || code "SAP_PROFIT_CENTER_CDE"
        from (select *, 'F1' code from {ruled} union all select *, 'F2' from {ruled}
              union all select *, 'F7' from {ruled}) x""",
    "customer_accounts": f"""
        select c_custkey c, {_id("c_custkey")} account, {_COMPANY.format("c_nationkey")} company,
               c_mktsegment, c_nationkey from {{customer}}""",
    "account_copies": """
        select *, 1 n from {customer_accounts}
        union all select *, 2 from {customer_accounts} where c % 6 = 1""",
    "customers_current": """
        select account submitted_customer_account_number,
               case when v.n = 1 and c % 3 = 0 then '1082' when v.n = 1 and c % 7 = 0 then '9999'
                    else company end customer_company_code,
               case when v.n = 1 then '10' when c % 5 = 0 then null else '05' end
                   distribution_channel_code,
               c * 10 + v.n customer_key_id,
               cast(case when c % 17 = 0 then 2 else 1 end as int) source_system_id,
               'S' || company sales_organization_id,
               cast(c % 50 as string) worldwide_customer_level_1_number,
               'WW1 ' || cast(c % 50 as string) worldwide_customer_level_1_label,
               cast(c % 20 as string) worldwide_customer_level_2_number,
               'WW2 ' || cast(c % 20 as string) worldwide_customer_level_2_label,
               n_name country_region_level_1_label, r_name country_region_level_2_label,
               'G3 ' || cast(c % 9 as string) gam_level_3_assoc_full_name,
               'A1 ' || cast(c % 8 as string) account_manager_level_1_assoc_full_name,
               'A6 ' || cast(c % 7 as string) account_manager_level_6_assoc_full_name,
               'A7 ' || cast(c % 6 as string) account_manager_level_7_assoc_full_name,
               'T1 ' || cast(c % 5 as string) sales_territory_level_1_assoc_full_name,
               'T6 ' || cast(c % 4 as string) sales_territory_level_6_assoc_full_name,
               'T7 ' || cast(c % 3 as string) sales_territory_level_7_assoc_full_name,
               'O' || cast(c % 11 as string) sales_office_code,
               'Office ' || cast(c % 11 as string) sales_office_label
        from {account_copies} v
        join {nation} on n_nationkey = c_nationkey join {region} on r_regionkey = n_regionkey
""",
    "customers": """
        select cast(c as string) customer_account_number, company customer_company_code,
               c_mktsegment industry_business_code,
               case when c % 29 = 0 then 'N' else 'Y' end record_active_indicator,
               cast(1 as int) source_system_id,
               cast(v.n as int) customer_company_legacy_format_account_number_rank,
               c % 4 customer_owning_business_unit_dsg_id,
               case when c % 3 = 0 then null else c % 3 end sales_territory_owning_business_unit_dsg_id,
               c % 2 + v.n gam_global_business_unit_owning_business_unit_dsg_id,
               'ST' || cast(c % 12 as string) sensors_alternate_sales_territory_code,
               'Territory ' || cast(c % 12 as string) sensors_alternate_sales_territory_name
        from (select *, 1 n from {customer_accounts} union all
              select *, 2 from {customer_accounts}) v""",
    "company_dim": """
        select bukrs company_code, case when bukrs = '0003' then 'N' else 'Y' end record_active_indicator,
               100 + cast(bukrs as bigint) company_dsg_id
        from {companies}""",
    "profit_centers": """
        select distinct segment profit_center_id,
               case segment when 'MACHINERY' then 'LGL' when 'HOUSEHOLD' then 'B2' else 'B1' end
                   business_unit_id,
               'Y' record_active_indicator
        from {ledger} where segment <> 'FURNITURE'
        union all
        select distinct "SAP_PROFIT_CENTER_CDE", 'B3', 'Y' from {profit_center_rules}
        union all
        select distinct 'PLACEHOLDER', 'TMP', 'Y' from {profit_center_rules}""",
    "business_units": """
        select business_unit_id, 'Y' record_active_indicator,
               cast(10 + length(business_unit_id) as bigint) business_unit_dsg_id,
               'G-' || business_unit_id business_unit_group_id
        from (select distinct business_unit_id from {profit_centers}) x""",
    "security_tags": """
        select distinct cast(c % 4 as string) security_key, 'TAG-' || cast(c % 4 as string) security_tag
        from {customer_accounts}
        union all
        select distinct '0-1-11-' || cast(company_dsg_id as string),
               'TAG-C' || cast(company_dsg_id as string) from {company_dim}
        union all
        select distinct '0-1-2-12-' || cast(company_dsg_id as string),
               'TAG-D' || cast(company_dsg_id as string) from {company_dim}""",
    "materials_current": f"""
        select {_id("p_partkey", 18)} material_number,
               case when p_partkey % 10 = 0 then null else p_name end material_description,
               p_brand product_structure_level_3_code, 'L3 ' || p_brand product_structure_level_3_label,
               p_type product_structure_level_4_code, 'L4 ' || p_type product_structure_level_4_label,
               cast(p_size as string) product_structure_level_5_code,
               'L5 ' || cast(p_size as string) product_structure_level_5_label,
               cast(case when p_partkey % 15 = 0 then 2 else 1 end as int) source_system_id
        from {{part}}
        union all
        select cast(p_partkey as string), 'short ' || p_name, p_brand, p_brand, p_type, p_type,
               cast(p_size as string), cast(p_size as string), 1
        from {{part}} where p_partkey % 50 = 1""",
    # A narrow ledger for the operators that need no more.
    "items": """
        select l.bukrs company, l.kunnr account, l.belnr doc, l.gjahr fiscal_year, l.buzei item,
               case when k % 3 = 0 then null else 1 end breakdown,
               case when status = 'F' then 'CLEARED' else 'OPEN' end status, segment centre,
               l.doc_day doc_date, l.posted post_date, l.cleared clearing_date,
               case when status = 'P' then '01' when k % 5 = 0 then null else '' end reason,
               case when k % 11 = 0 then 'H' else 'S' end dc,
               30 * cast(priority as int) term_days,
               case when k % 12 = 0 then null
                    else l.doc_day + 30 * cast(priority as int) end due_date,
               waers currency, amount, cast(k as bigint) k
        from {ledger} l""",
    # A narrow snapshot of 75 days, with every fault the checks look for.
    "history": f"""
        select {{as_of}} - cast(k % 75 as int) snapshot_date, i.status snapshot_state,
               company company_code, doc accounting_document_id,
               fiscal_year accounting_document_posting_fiscal_year_id,
               item accounting_document_item_id, breakdown accounting_document_breakdown_item_id,
               doc billing_document_id, {_id("l_linenumber", 6)} billing_document_item_id,
               cast(l_partkey as string) material_number,
               clearing_date accounting_document_item_clearing_date,
               i.status accounting_document_item_clearing_status_name, due_date, reason,
               cast(l_extendedprice as decimal(36,3)) money
        from {{lineitem}} join {{items}} i on l_orderkey = k""",
    "snapshot": """
        select *,
               cast(case when snapshot_state = 'OPEN' then money else 0 end as decimal(36,3))
                   material_open_functional_amount,
               cast(case when snapshot_state = 'OPEN' and reason = '01' then money else 0 end
                    as decimal(36,3)) material_disputed_functional_amount,
               cast(case when snapshot_state = 'OPEN' and coalesce(reason, '') <> '01'
                    and due_date >= {as_of} then money else 0 end
                    as decimal(36,3)) material_current_due_functional_amount,
               cast(case when snapshot_state = 'OPEN' and coalesce(reason, '') <> '01'
                    and not coalesce(due_date >= {as_of}, false)
                    then money - case when material_number like '%7' then 1 else 0 end
                    else 0 end as decimal(36,3)) material_past_due_functional_amount
        from {history}""",
    # The material fact of the history: its rows and open amounts, without the slices.
    "mart": """
        select snapshot_state, company_code, accounting_document_id,
               accounting_document_posting_fiscal_year_id, accounting_document_item_id,
               accounting_document_breakdown_item_id, billing_document_id, billing_document_item_id,
               material_number, accounting_document_item_clearing_date,
               accounting_document_item_clearing_status_name, due_date, reason, money,
               cast(case when snapshot_state = 'OPEN' then money else 0 end as decimal(36,3))
                   material_open_functional_amount
        from {history}""",
    "snapshot_open": """
        select * from {snapshot} where snapshot_state = 'OPEN' and material_number not like '%9'""",
    "snapshot_archive": """
        select *, snapshot_date + 61 archived_on_date from {snapshot}
        where snapshot_date < {as_of} - 60""",
}


def _names(sql: str) -> list[str]:
    return sorted({*re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)})


def _text(name: str) -> str:
    return FRAMES[name].replace("{as_of}", f"date '{AS_OF}'")


_STORED: dict[tuple[str, str], dict[str, tuple[str, StructType]]] = {}

# Tables that a join or a grouping stands behind; the others are projections of these.
STORED = """
    ledger payment_terms companies currency_decimals dated_rates budget_rates
    profit_center_fence products ruled customers_current profit_centers business_units
    company_dim security_tags mart
""".split()


class Frames:
    """The tables of one data folder as lazy DataFrames; items build what they need.

    Where the library is used, a ledger or a customer dimension is a table of its own and
    not a query.  ``tables`` gives them as such: derived once per session, written to the
    shared folder and read back from there.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._built = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._raw(name) if name in RAW else self._derived(name)
        return self._built[name]

    def _raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derived(self, name: str) -> DataFrame:
        sql = _text(name)
        parts = {n: self[n] for n in _names(sql)}
        return self.spark.sql(sql.replace('"', "`"), **parts)

    def tables(self, names: list[str]) -> dict[str, DataFrame]:
        wanted = [n for name in names for n in needed(name) if n in STORED]
        paths = _STORED.setdefault((self.spark.sparkContext.applicationId, self.folder), {})
        while missing := [n for n in dict.fromkeys(wanted) if n not in paths]:
            ready = [n for n in missing
                     if all(p in paths for p in needed(n)[:-1] if p in STORED)]
            for name in paths:
                self._built[name] = self._read(*paths[name])
            frames = {n: self[n] for n in ready}
            root = shared_folder(self.spark)
            with released_shuffles(self.spark), ThreadPoolExecutor(8) as pool:
                plans = {n: frames[n].select("*") for n in ready}
                list(pool.map(lambda n: plans[n].write.parquet(f"{root}/{n}"), ready))
            paths.update({n: (f"{root}/{n}", frames[n].schema) for n in ready})
            self._built.clear()
        for name in paths:
            self._built[name] = self._read(*paths[name])
        return {n: self[n] for n in names}

    def _read(self, path: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path)


@cache
def needed(name: str) -> tuple[str, ...]:
    """Derived tables that ``name`` is built from, in build order, itself last."""
    order: list[str] = []
    for part in _names(_text(name)):
        if part not in RAW:
            order += [p for p in needed(part) if p not in order]
    return (*order, name)


def duckdb_with(*names: str) -> str:
    """A WITH list that defines the derived tables ``names`` for DuckDB."""
    order: list[str] = []
    for name in names:
        order += [n for n in needed(name) if n not in order]
    parts = [f"{n} as ({re.sub(r'{(\w+)}', r'\1', _text(n))})" for n in order]
    return "with " + ",\n".join(parts)
