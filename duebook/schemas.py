"""Column lists of the stages.  Everything in this file is a fixed value: the names
must equal those of the tables people already query."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

# Columns read from the open and the cleared ledger.
LEDGER_COLUMNS = """
    bukrs kunnr belnr gjahr buzei blart bldat budat augbl augdt shkzg xzahl vbeln sgtxt
    zfbdt zterm zbd1t zbd2t zbd3t waers wrbtr dmbtr rstgr saknr
""".split()

# Customer hierarchy columns, source name -> output name.
HIERARCHY = {
    "sales_organization_id": "sales_organization_id",
    "distribution_channel_code": "distribution_channel_code",
    "worldwide_customer_level_1_number": "worldwide_customer_level_1_number",
    "worldwide_customer_level_1_label": "worldwide_customer_level_1_name",
    "worldwide_customer_level_2_number": "worldwide_customer_level_2_number",
    "worldwide_customer_level_2_label": "worldwide_customer_level_2_name",
    "country_region_level_1_label": "country_region_level_1_name",
    "country_region_level_2_label": "country_region_level_2_name",
    "gam_level_3_assoc_full_name": "gam_level_3_assoc_full_name",
    "account_manager_level_6_assoc_full_name": "account_manager_level_6_assoc_full_name",
    "account_manager_level_7_assoc_full_name": "account_manager_level_7_assoc_full_name",
    "sales_territory_level_6_assoc_full_name": "sales_territory_level_6_assoc_full_name",
    "sales_territory_level_7_assoc_full_name": "sales_territory_level_7_assoc_full_name",
    "sales_office_code": "sales_office_code",
    "sales_office_label": "sales_office_name",
    "account_manager_level_1_assoc_full_name": "account_manager_assoc_full_name",
    "sales_territory_level_1_assoc_full_name": "sales_territory_assoc_full_name",
}

# Output columns of the invoice fact.
INVOICE_COLUMNS = """
    company_code customer_account_number accounting_document_id
    accounting_document_posting_fiscal_year_id accounting_document_item_id
    accounting_document_type_code accounting_document_create_date accounting_document_posting_date
    accounting_document_item_clearing_document_id accounting_document_item_clearing_date
    accounting_document_item_credit_or_debit_code
    accounting_document_item_posting_key_used_in_payment_indicator
    accounting_document_item_invoice_document_id accounting_document_item_text
    accounting_document_item_baseline_date accounting_document_item_due_date
    accounting_document_item_payment_terms_code
    accounting_document_item_cash_discount_days_quantity_1
    accounting_document_item_cash_discount_days_quantity_2
    accounting_document_create_network_user_id accounting_document_item_document_currency_code
    accounting_document_item_functional_currency_code accounting_document_item_payment_reason_code
    accounting_document_item_clearing_status_name ted_overriding_profit_center_id profit_center_id
    ted_profit_center_id ted_profit_center_effective_date accounting_document_breakdown_item_id
    accounting_document_item_document_currency_amount
    accouting_document_item_general_ledger_reconciliation_account_number
    accounting_document_item_functional_currency_amount
    accounting_document_item_actual_rate_functional_amount
    accounting_document_item_tariff_percentage data_security_tag_id business_unit_group_id
    accounting_document_item_budget_rate_amount sold_to_customer_number
""".split() + [*HIERARCHY.values(), "sensors_alternate_sales_territory_code",
               "sensors_alternate_sales_territory_name"]

# Aging bucket columns per grain, in the order open, disputed, current, past, cleared.
ITEM_BUCKETS = """
    receivable_open_actual_rate_functional_amount
    receivable_disputed_actual_rate_functional_amount
    receivable_current_due_actual_rate_functional_amount
    receivable_past_due_actual_rate_functional_amount
    invoice_cleared_actual_rate_functional_amount
""".split()
MATERIAL_BUCKETS = """
    material_open_functional_amount material_disputed_functional_amount
    material_current_due_functional_amount material_past_due_functional_amount
    material_cleared_functional_amount
""".split()

# The other columns of the material fact.
MATERIAL_COLUMNS = """
    billing_document_id billing_document_item_id material_number raw_material_number
    material_description material_quantity material_unit_of_measure_code
    material_billing_line_net_value material_billing_line_gross_value
""".split()
PRODUCT_COLUMNS = """
    product_hierarchy_l3_code product_hierarchy_l3_name product_hierarchy_l4_code
    product_hierarchy_l4_name material_cbc_code material_cbc_name
""".split()
PRORATE_COLUMNS = """
    material_prorate_factor billing_doc_total_net_value billing_doc_line_item_count
""".split()
MATERIAL_AMOUNTS = ["material_document_currency_amount", "material_actual_rate_functional_amount"]

SKU_COLUMNS = (INVOICE_COLUMNS + ITEM_BUCKETS + MATERIAL_COLUMNS + PRODUCT_COLUMNS
               + PRORATE_COLUMNS + MATERIAL_AMOUNTS + MATERIAL_BUCKETS)
SNAPSHOT_COLUMNS = ["snapshot_date", "snapshot_state"] + SKU_COLUMNS
ARCHIVE_COLUMNS = SNAPSHOT_COLUMNS + ["archived_on_date"]

# Unique key of the snapshot and of the archive.
SNAPSHOT_KEY = """
    snapshot_date snapshot_state company_code accounting_document_id
    accounting_document_posting_fiscal_year_id accounting_document_item_id
    accounting_document_breakdown_item_id billing_document_id billing_document_item_id
    material_number
""".split()

# Columns of a check result.
CHECK_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("run_date", T.DateType()),
    T.StructField("violation_count", T.LongType()),
    T.StructField("sample_detail", T.StringType()),
])


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fail while the plan is built, not after hours of running, when a stage lost a column."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df
