"""The invoice plan: shuffles of the ledger, and the delta load against the full one."""

import pytest
from pyspark.sql import functions as F

from duebook.plans import delta, invoice, sku
from tests.conftest import DATA
from tests.helpers import rows
from workload.frames import AS_OF, Frames


@pytest.fixture(scope="module")
def sources(spark):
    return Frames(spark, DATA).tables([*invoice.TABLES, "security_tags"])


@pytest.fixture
def without_broadcast(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def exchanges(node, carrying):
    """Shuffles in a physical plan whose rows have a column."""
    found = []
    if "ShuffleExchange" in node.getClass().getSimpleName():
        names = [node.output().apply(i).name() for i in range(node.output().size())]
        found += [node] if carrying in names else []
    for i in range(node.children().size()):
        found += exchanges(node.children().apply(i), carrying)
    return found


def test_the_ledger_is_shuffled_twelve_times_at_most(sources, without_broadcast):
    fact = invoice.invoice_columns(invoice.invoice_base(sources, AS_OF), sources["security_tags"])
    plan = fact._jdf.queryExecution().executedPlan()
    # a column that no table but the ledger has
    assert 0 < len(exchanges(plan, "saknr")) <= 12


def test_the_large_tables_meet_a_narrow_frame(sources, without_broadcast):
    """The wide ledger is shuffled to meet it and for the small tables, and not for columns nobody reads."""
    base = invoice.invoice_base(sources, AS_OF)
    fact = invoice.invoice_columns(base, sources["security_tags"])._jdf.queryExecution().executedPlan()
    assert 0 < len(exchanges(fact, "saknr")) <= 8
    few = base.select(*invoice.ITEM, "auzei", "customer_key_id")._jdf.queryExecution().executedPlan()
    assert not exchanges(few, "saknr") and not exchanges(few, "wrbtr")


def test_unmatched_items_are_dealt_by_their_key(sources, without_broadcast):
    """Items without a billing line are spread by what tells them apart, not by columns nobody reads."""
    fact = invoice.invoice_columns(invoice.invoice_base(sources, AS_OF), sources["security_tags"])
    lines = sources["billing_lines"]
    current = sources["materials"].selectExpr(
        "matnr material_number", "'d' material_description", "1 source_system_id",
        *[f"'x' product_structure_level_{n}_{kind}" for n in (3, 4, 5) for kind in ("code", "label")])
    rows = sku.sku_fact(fact, lines, current, AS_OF, keep_unmatched=True, split_hot_keys=False).select(
        "accounting_document_id", "material_actual_rate_functional_amount")
    plan = rows._jdf.queryExecution().executedPlan()
    assert exchanges(plan, "accounting_document_id")
    for unread in ("saknr", "sgtxt"):
        assert not exchanges(plan, unread)


def test_items_without_a_key_meet_their_customers(sources):
    """Null parts of an item's key find what the other columns lead to; the newest of its rows stays."""
    one = sources["open_items"].where("kunnr is not null").orderBy("belnr").limit(1)
    null = F.lit(None).cast("string")
    odd = one.withColumns({"belnr": null, "buzei": null})
    more = odd.withColumns({"budat": F.lit("19900101"), "vbeln": null})
    tables = {**sources, "open_items": sources["open_items"].unionByName(odd).unionByName(more)}
    base = invoice.invoice_base(tables, AS_OF).where("belnr is null").select(
        "kunnr", "sold_to_customer_number", "plain_account", "customer_key_id").collect()
    asked = one.first()
    assert [(r.kunnr, r.plain_account) for r in base] == [(asked.kunnr, asked.kunnr.lstrip("0"))]
    assert base[0].sold_to_customer_number


def test_traceability_has_all_candidates(sources):
    base = invoice.invoice_base(sources, AS_OF)
    assert {"mapped_company_code", "payer", "first_customer", "direct_customer", "delivery_customer",
            "sold_to_resolution_source", "customer_key_resolution_tier"} <= set(base.columns)


def test_only_affected_documents_are_computed(spark, sources):
    """One header, one rate and one customer: few documents, and all whose rows differ."""
    fact = invoice.invoice_fact(sources, AS_OF, split_hot_keys=False)
    before = spark.createDataFrame(fact.collect(), fact.schema)
    header = sources["document_headers"].orderBy("belnr").limit(1)
    rate = sources["dated_rates"].where("from_currency = 'KWD'").orderBy("reference_date").limit(1)
    customer = sources["customers_current"].orderBy("customer_key_id").limit(1)
    edits = {"document_headers": (header, ["bukrs", "belnr", "gjahr"], "usnam", F.lit("changed")),
             "dated_rates": (rate, ["reference_date", "from_currency"], "exchange_rate",
                             F.lit(9).cast("decimal(18,4)")),
             "customers_current": (customer, ["customer_key_id"], "sales_office_label", F.lit("moved"))}
    now, changes = dict(sources), {}
    for name, (old, keys, column, value) in edits.items():
        new = old.withColumn(column, value)
        now[name] = sources[name].join(old.select(keys), keys, "left_anti").unionByName(new)
        changes[name] = old.unionByName(new)
    found, documents = delta.delta_fact(now, changes, before, AS_OF)
    total = sources["document_headers"].count()
    assert 0 < documents.count() < total / 4
    full = invoice.invoice_fact(now, AS_OF, split_hot_keys=False)
    assert rows(delta.merged_fact(before, found, documents)) == rows(full)
    assert rows(full) != rows(before)


def test_every_source_has_a_path_to_the_ledger(spark, sources):
    paths = delta.Paths(sources, invoice.invoice_fact(sources, AS_OF, split_hot_keys=False))
    for name in [*invoice.TABLES, "security_tags"]:
        found = paths.by_table(name, sources[name].limit(1))
        assert found.columns == invoice.DOCUMENT, name
    with pytest.raises(ValueError, match="no path"):
        paths.by_table("unknown", sources["companies"])


def test_documents_that_lose_their_items_leave_the_fact(spark, sources):
    fact = invoice.invoice_fact(sources, AS_OF, split_hot_keys=False)
    before = spark.createDataFrame(fact.collect(), fact.schema)
    lost = sources["open_items"].orderBy("belnr").limit(1)
    key = invoice.DOCUMENT
    now = {**sources, **{n: sources[n].join(lost.select(key), key, "left_anti")
                         for n in ("open_items", "cleared_items")}}
    found, documents = delta.delta_fact(now, {"open_items": lost}, before, AS_OF)
    assert found.count() == 0 and documents.count() == 1
    assert delta.merged_fact(before, found, documents).count() < before.count()


def test_affected_documents_are_found_once(sources):
    """The joins that reduce the sources read stored keys, not the paths that led to them."""
    one = sources["open_items"].orderBy("belnr").limit(1)
    fact = invoice.invoice_columns(invoice.invoice_base(sources, AS_OF), sources["security_tags"])
    _, documents = delta.delta_fact(sources, {"open_items": one}, fact, AS_OF)
    assert all("/documents/" in file for file in documents.inputFiles())
    assert documents.count() == 1
