import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.contracts import CONTRACTS
from tallylake.operators import quality as q
from tallylake.operators import reconcile as r
from tallylake.operators.migrate import migration_plan, preserve_legacy
from tallylake.plans import gold
from tallylake.plans.gold_tests import test_names as gold_test_names
from tallylake.sources.tables import SilverTable, VersionedTable

DAY = datetime.date(2024, 1, 1)
VOLUME = "transaction_date DATE, currency_code STRING, transaction_count BIGINT, gross_volume DECIMAL(28,4)"


def test_null_keys_show_on_both_sides(spark):
    rows = [(DAY, "USD", 1, Decimal(5)), (DAY, None, 2, Decimal(7))]
    volume = spark.createDataFrame(rows, VOLUME)
    found = q.volume_recon_mismatches(volume, volume).collect()
    assert sorted((r_.expected_transaction_count or 0, r_.actual_transaction_count or 0) for r_ in found) == [
        (0, 2), (2, 0),
    ]


def test_orphans_include_null_keys_and_hot_keys(spark):
    ledger = spark.createDataFrame(
        [(n, "hot") for n in range(50)] + [(50, None), (51, "known"), (52, "known")],
        "entry_id INT, account_id STRING",
    )
    accounts = spark.createDataFrame([("known",)], "account_id STRING")
    found = q.orphan_rows(ledger, "account_id", accounts, "account_id")
    assert sorted(r_.entry_id for r_ in found.collect()) == list(range(51))
    assert q.orphan_rows(ledger.where("entry_id > 50"), "account_id", accounts, "account_id").isEmpty()


def test_domains_let_nulls_pass(spark):
    df = spark.createDataFrame([("a",), (None,), ("x",), ("x",)], "c STRING")
    found = q.accepted_value_violations(df, {"c": ("a", "b")}).collect()
    assert [tuple(f) for f in found] == [("c", "x", 2)]


def test_unique_ignores_nulls_and_relationships_too(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "c STRING")
    assert [tuple(f) for f in q.unique_violations(df, "c").collect()] == [("a", 2)]
    parent = spark.createDataFrame([("b",)], "k STRING")
    found = q.relationship_violations(df, "c", parent, "k").collect()
    assert [tuple(f) for f in found] == [("a", 2)]


def test_there_are_33_tests_and_passes_are_reported(spark):
    assert len(gold_test_names()) == len(set(gold_test_names())) == 33
    failing = spark.createDataFrame([("b", 2), ("b", 1)], "test STRING, failures BIGINT")
    report = q.quality_report(["a", "b"], [failing])
    assert {tuple(row) for row in report.collect()} == {("a", 0), ("b", 3)}


def test_schema_difference_in_order_type_and_flag(spark):
    contract = CONTRACTS["accounts"].schema
    assert q.schema_diff(spark, contract, contract).isEmpty()
    swapped = T.StructType([contract.fields[1], contract.fields[0], *contract.fields[2:]])
    assert q.schema_diff(spark, swapped, contract).count() == 2
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in contract.fields])
    assert q.schema_diff(spark, loose, contract).count() == 3


def test_the_day_follows_the_business_zone(spark):
    row = [("t", datetime.datetime(2026, 8, 13, 1, tzinfo=datetime.timezone.utc), "BRL", Decimal(1), "completed")]
    df = spark.createDataFrame(row, "transaction_id STRING, created_at TIMESTAMP, currency STRING, amount DECIMAL(18,4), status STRING")
    day = {z: gold.daily_volume(df, z).first().transaction_date for z in ("UTC", "America/Sao_Paulo")}
    assert str(day["UTC"]) == "2026-08-13" and str(day["America/Sao_Paulo"]) == "2026-08-12"
    assert gold.daily_volume(df, unique_keys=True).first().transaction_count == 1


def test_position_sums_equal_the_direct_form(spark):
    ledger = spark.range(400).select(
        F.when(F.col("id") < 150, 0).otherwise(F.col("id") % 7).alias("account_id"),
        F.when(F.col("id") % 2 == 0, "debit").otherwise("credit").alias("entry_type"),
        (F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(-F.col("id"))).cast("decimal(18,4)").alias("amount"),
        F.when(F.col("id") % 3 == 0, "USD").otherwise("BRL").alias("currency"),
    )
    accounts = spark.range(6).select(F.col("id").alias("account_id"), (F.col("id") % 2).alias("partner_id"))
    direct = gold._movements(gold.ledger_with_partner(ledger, accounts), ["partner_id", "currency_code"])
    summed = gold.partner_net_position(ledger, accounts)
    columns = direct.columns
    assert {tuple(x) for x in summed.select(columns).collect()} == {tuple(x) for x in direct.collect()}


def test_batch_reconciliation_finds_the_three_failures(spark):
    schema = "k STRING, _cdc_lsn BIGINT, _cdc_deleted BOOLEAN"
    batch = spark.createDataFrame([("a", 1, False), ("b", 5, False), ("c", 5, True), ("d", 5, False)], schema)
    state = spark.createDataFrame([("b", 4, False), ("c", 5, False), ("d", 9, True)], schema)
    found = r.batch_state_failures(batch, state, "k").orderBy("key").collect()
    assert [(f.key, f.reason) for f in found] == [
        ("a", r.ABSENT), ("b", r.OLDER), ("c", r.TOMBSTONE),
    ]
    assert r.failure_sample(r.batch_state_failures(batch, state, "k"), 2).count() == 2


def test_an_empty_ledger_totals_zero(spark):
    empty = spark.createDataFrame([], "amount DECIMAL(18,4), _cdc_deleted BOOLEAN")
    assert r.ledger_total(empty).first().ledger_total == 0


def test_a_state_past_the_cutoff_can_be_cut(spark):
    rows = [("a", Decimal(1), 1, False), ("b", Decimal(-1), 2, False), ("c", Decimal(0), 9, False)]
    ledger = spark.createDataFrame(rows, "k STRING, amount DECIMAL(18,4), _cdc_lsn BIGINT, _cdc_deleted BOOLEAN")
    bronze, silver = {"ledger_entries": ledger.where("_cdc_lsn <= 5")}, {"ledger_entries": ledger}
    open_, cut = (
        {x.item: x.in_sync for x in r.reconcile_cutoff(bronze, silver, 5, flag).collect()}
        for flag in (False, True)
    )
    assert open_ == {"rows:ledger_entries": False, "ledger_total": True}
    assert cut == {"rows:ledger_entries": True, "ledger_total": True}
    assert r.rows_past_cutoff(silver, 5).first().rows == 1


def test_migration_moves_only_what_differs_and_overwrites_nothing(spark, tmp_path):
    lake, contracts = str(tmp_path), {n: CONTRACTS[n] for n in ("partners", "accounts", "ledger_entries")}
    for name in ("partners", "ledger_entries"):
        contract = contracts[name]
        fields = [T.StructField(f.name, f.dataType) for f in contract.schema.fields]
        rows = spark.createDataFrame([tuple(None for _ in fields)], T.StructType(fields))
        table = SilverTable(spark, f"{lake}/silver/{name}", contract)
        table.publish(table.write_state(rows, contract.day_column))
    assert migration_plan(spark, lake, contracts).isEmpty()
    VersionedTable(spark, f"{lake}/silver/accounts").replace(spark.range(3))
    plan = migration_plan(spark, lake, contracts)
    assert [(row.table, row.rows) for row in plan.collect()] == [("accounts", 3)]
    stored = VersionedTable(spark, f"{lake}/silver/accounts").read()
    differing = q.stored_schema_diff(spark, stored, contracts["accounts"].schema).collect()
    assert {r.rows for r in differing} == {3} and differing[0].actual == "id bigint"
    moved, = preserve_legacy(spark, lake, plan).collect()
    assert moved.preserved_rows == 3
    assert VersionedTable(spark, f"{lake}/{moved.target}").read().count() == 3
    VersionedTable(spark, f"{lake}/silver/accounts").replace(spark.range(1))
    with pytest.raises(FileExistsError):
        migration_plan(spark, lake, contracts)


def _report_tables(spark):
    """Gold tables with a few faults each, as few rows, and staging that fits them."""
    def frame(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    money = "DECIMAL(28,4)"
    tables = {
        "dim_partners": frame("partner_id STRING, partner_type STRING, status STRING", ("p1", "bank", "active"), ("p1", "odd", "active"), (None, "odd", "active")),
        "dim_accounts": frame(
            "account_id STRING, partner_id STRING, account_currency STRING, account_type STRING, status STRING",
            ("a1", "p1", "BRL", "fee", "active"), ("a1", "p9", "XXX", "fee", "odd"), ("a1", None, None, "fee", "other"), (None, "p9", "BRL", "fee", "odd")),
        "dim_currencies": frame("currency_code STRING", ("BRL",)),
        "fct_daily_volume": frame(
            f"transaction_date DATE, currency_code STRING, transaction_count BIGINT, gross_volume {money}",
            *[(None, "BRL", 1, Decimal(1)), (None, "BRL", 1, Decimal(1)), (None, "USD", None, Decimal(1))]),
        "fct_partner_net_position": frame(
            f"partner_id STRING, currency_code STRING, entry_count BIGINT, total_debits {money}, total_credits {money}, net_position {money}",
            ("p1", "BRL", 1, Decimal(1), Decimal(0), None), ("p1", "BRL", 1, Decimal(1), Decimal(0), Decimal(0)), ("p9", "USD", 1, Decimal(1), Decimal(0), Decimal(0))),
    }
    staging = {
        "stg_ledger_entries": frame("account_id STRING, transaction_id STRING, currency STRING, entry_type STRING, amount DECIMAL(18,4)",
                                    ("a1", "t1", "BRL", "debit", Decimal(5)), ("a7", "t1", "BRL", "credit", Decimal(-4)), (None, "t2", "USD", "debit", Decimal(0))),
        "stg_transactions": frame("transaction_id STRING, amount DECIMAL(18,4), currency STRING, status STRING, created_at TIMESTAMP_NTZ"),
    }
    return tables, staging


def test_the_report_counts_each_fault_and_skips_what_was_observed(spark):
    from tallylake.plans.gold_tests import gold_quality_report, observed, passed_tests, test_names

    tables, staging = _report_tables(spark)
    full = {r.test: r.failures for r in gold_quality_report(tables, staging).collect()}
    assert sorted(full) == sorted(test_names()) and len(full) == 33
    assert {t: n for t, n in full.items() if n} == {
        "not_null:dim_partners.partner_id": 1, "not_null:dim_accounts.account_id": 1, "not_null:dim_accounts.partner_id": 1,
        "not_null:dim_accounts.account_currency": 1, "not_null:fct_daily_volume.transaction_date": 3,
        "not_null:fct_daily_volume.transaction_count": 1, "not_null:fct_partner_net_position.net_position": 1,
        "unique:dim_partners.partner_id": 1, "unique:dim_accounts.account_id": 1,
        "accepted_values:dim_partners.partner_type": 1, "accepted_values:dim_accounts.account_currency": 1,
        "accepted_values:dim_accounts.status": 2,
        "relationships:dim_accounts.partner_id": 2, "relationships:fct_daily_volume.currency_code": 1,
        "relationships:fct_partner_net_position.partner_id": 1, "relationships:fct_partner_net_position.currency_code": 1,
        "unique_grain:fct_daily_volume": 1, "unique_grain:fct_partner_net_position": 1,
        "ledger_entries_have_account": 2, "ledger_entries_sum_to_zero": 1, "daily_volume_matches_state": 2, "net_position_matches_ledger": 2,
    }
    seen = []
    for name, df in tables.items():
        watched, one = observed(name, df)
        watched.write.format("noop").mode("overwrite").save()
        seen.append(one)
    passed = passed_tests(seen)
    assert passed == {t for t, n in full.items() if not n and t.startswith(("not_null", "accepted"))}
    report = gold_quality_report(tables, staging, passed=passed)
    assert {r.test: r.failures for r in report.collect()} == full


def test_key_tests_scan_a_table_once(spark, tmp_path):
    from tallylake.plans.gold_tests import key_failures

    tables, _ = _report_tables(spark)
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    stored = {name: spark.read.schema(df.schema).parquet(str(tmp_path / name)) for name, df in tables.items()}
    plan = key_failures(stored)._jdf.queryExecution().executedPlan().toString()
    # Each of five tables once for its keys, and four times as a parent.
    assert plan.count("FileScan parquet") == 9 and plan.count("Expand") == 5
