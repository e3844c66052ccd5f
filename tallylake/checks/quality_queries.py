"""Data tests over the finance tables with seeded faults."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.checks import bindings as b
from tallylake.checks.gold_queries import SUM, stg
from tallylake.checks.registry import query, with_tables
from tallylake.contracts import CONTRACTS, CURRENCIES, ACCOUNT_STATUSES, ACCOUNT_TYPES, PARTNER_TYPES
from tallylake.operators import quality as q
from tallylake.plans import gold
from tallylake.plans.gold_tests import gold_quality_report, observed, passed_tests, relationship_tests
from tallylake.plans.staging import staging_live_rows
from tallylake.session import new_run_folder


def faulted_models(spark, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Staging with faults, and Gold built from it but for a volume fact built from clean rows."""
    staging = {
        "stg_partners": staging_live_rows(b.faulted_partners(spark, sf_dir)),
        "stg_accounts": staging_live_rows(b.faulted_accounts(spark, sf_dir)),
        "stg_transactions": staging_live_rows(b.faulted_transactions(spark, sf_dir)),
        "stg_ledger_entries": staging_live_rows(b.faulted_ledger(spark, sf_dir)),
    }
    models = gold.build_gold(staging)
    models["fct_daily_volume"] = gold.daily_volume(stg("transactions", spark, sf_dir))
    return models, staging


F_POSITIONS = """fct_position AS (
SELECT a.partner_id, l.currency AS currency_code, COUNT(*) AS entry_count,
  SUM(CASE WHEN entry_type = 'debit' THEN amount ELSE 0 END) AS total_debits,
  SUM(CASE WHEN entry_type = 'credit' THEN -amount ELSE 0 END) AS total_credits,
  -SUM(amount) AS net_position
FROM f_ledger l JOIN f_accounts a ON l.account_id = a.account_id
WHERE NOT l._cdc_deleted GROUP BY 1, 2)"""
F_CURRENCIES = """dim_currencies AS (
SELECT DISTINCT currency AS currency_code FROM f_accounts WHERE currency IS NOT NULL)"""
F_VOLUME = """fct_volume AS (
SELECT CAST(created_at AS DATE) AS d, currency AS currency_code, COUNT(DISTINCT transaction_id) AS n,
  SUM(amount) AS v FROM b_transactions WHERE status = 'completed' AND NOT _cdc_deleted GROUP BY 1, 2)"""
F_EXPECTED_VOLUME = """expected_volume AS (
SELECT CAST(created_at AS DATE) AS d, currency AS currency_code, COUNT(DISTINCT transaction_id) AS n,
  SUM(amount) AS v FROM f_transactions WHERE status = 'completed' AND NOT _cdc_deleted GROUP BY 1, 2)"""
F_BY_CURRENCY = """by_currency AS (
SELECT currency AS currency_code, COUNT(*) AS entry_count,
  SUM(CASE WHEN entry_type = 'debit' THEN amount ELSE 0 END) AS total_debits,
  SUM(CASE WHEN entry_type = 'credit' THEN -amount ELSE 0 END) AS total_credits,
  -SUM(amount) AS net_position FROM f_ledger WHERE NOT _cdc_deleted GROUP BY 1), fact_by_currency AS (
SELECT currency_code, SUM(entry_count) AS entry_count, SUM(total_debits) AS total_debits,
  SUM(total_credits) AS total_credits, SUM(net_position) AS net_position FROM fct_position GROUP BY 1)"""
POSITION_DIFFERS = """b.entry_count IS DISTINCT FROM f.entry_count
   OR b.total_debits IS DISTINCT FROM f.total_debits OR b.total_credits IS DISTINCT FROM f.total_credits
   OR b.net_position IS DISTINCT FROM f.net_position"""


@query("ledger_orphans", with_tables("f_ledger b_accounts", """
SELECT l.entry_id, l.account_id FROM f_ledger l LEFT JOIN b_accounts a ON l.account_id = a.account_id
WHERE NOT l._cdc_deleted AND a.account_id IS NULL"""))
def _orphans(spark, sf_dir):
    ledger = staging_live_rows(b.faulted_ledger(spark, sf_dir), ["entry_id", "account_id"])
    accounts = gold.dim_accounts(stg("accounts", spark, sf_dir))
    return q.orphan_rows(ledger, "account_id", accounts, "account_id")


@query("relationship_violations", with_tables(
    "f_ledger f_accounts f_partners b_transactions", f"""
WITH {F_POSITIONS}, {F_CURRENCIES}, {F_VOLUME}
SELECT 'dim_accounts.partner_id' AS relationship, CAST(partner_id AS VARCHAR) AS value, COUNT(*) AS n_records
FROM f_accounts WHERE partner_id NOT IN (SELECT partner_id FROM f_partners) GROUP BY 2
UNION ALL SELECT 'fct_daily_volume.currency_code', currency_code, COUNT(*) FROM fct_volume
WHERE currency_code NOT IN (SELECT currency_code FROM dim_currencies) GROUP BY 2
UNION ALL SELECT 'fct_partner_net_position.partner_id', CAST(partner_id AS VARCHAR), COUNT(*) FROM fct_position
WHERE partner_id NOT IN (SELECT partner_id FROM f_partners) GROUP BY 2
UNION ALL SELECT 'fct_partner_net_position.currency_code', currency_code, COUNT(*) FROM fct_position
WHERE currency_code NOT IN (SELECT currency_code FROM dim_currencies) GROUP BY 2"""))
def _relationships(spark, sf_dir):
    models, _ = faulted_models(spark, sf_dir)
    return reduce(DataFrame.unionByName, relationship_tests(models))


@query("volume_recon_mismatches", with_tables("f_transactions", f"""
WITH {F_VOLUME}, {F_EXPECTED_VOLUME}
SELECT strftime(COALESCE(s.d, g.d), '%Y-%m-%d') AS transaction_date,
  COALESCE(s.currency_code, g.currency_code) AS currency_code,
  s.n AS expected_transaction_count, g.n AS actual_transaction_count,
  CAST(s.v AS DECIMAL(28,4)) AS expected_gross_volume, CAST(g.v AS DECIMAL(28,4)) AS actual_gross_volume
FROM expected_volume s FULL OUTER JOIN fct_volume g ON s.d = g.d AND s.currency_code = g.currency_code
WHERE COALESCE(s.n, 0) <> COALESCE(g.n, 0) OR COALESCE(s.v, 0) <> COALESCE(g.v, 0)"""))
def _volume_recon(spark, sf_dir):
    expected = gold.daily_volume(staging_live_rows(b.faulted_transactions(spark, sf_dir)))
    actual = gold.daily_volume(stg("transactions", spark, sf_dir))
    return q.volume_recon_mismatches(expected, actual).select(
        F.col("transaction_date").cast("string").alias("transaction_date"), "currency_code",
        "expected_transaction_count", "actual_transaction_count",
        F.col("expected_gross_volume").cast(SUM).alias("expected_gross_volume"),
        F.col("actual_gross_volume").cast(SUM).alias("actual_gross_volume"),
    )


@query("position_recon_mismatches", with_tables("f_ledger f_accounts", f"""
WITH {F_POSITIONS}, {F_BY_CURRENCY}
SELECT COALESCE(b.currency_code, f.currency_code) AS currency_code,
  CAST(b.entry_count AS BIGINT) AS expected_entry_count, CAST(f.entry_count AS BIGINT) AS actual_entry_count,
  CAST(b.net_position AS DECIMAL(28,4)) AS expected_net_position,
  CAST(f.net_position AS DECIMAL(28,4)) AS actual_net_position
FROM by_currency b FULL OUTER JOIN fact_by_currency f ON b.currency_code = f.currency_code
WHERE {POSITION_DIFFERS}"""))
def _position_recon(spark, sf_dir):
    models, staging = faulted_models(spark, sf_dir)
    differing = q.position_recon_mismatches(
        gold.ledger_by_currency(staging["stg_ledger_entries"]),
        gold.position_rollup(models["fct_partner_net_position"]),
    )
    return differing.select(
        "currency_code", "expected_entry_count", "actual_entry_count",
        F.col("expected_net_position").cast(SUM).alias("expected_net_position"),
        F.col("actual_net_position").cast(SUM).alias("actual_net_position"),
    )


@query("unbalanced_transactions", with_tables("f_ledger", """
SELECT transaction_id, CAST(SUM(amount) AS DECIMAL(28,4)) AS unbalanced_amount
FROM f_ledger WHERE NOT _cdc_deleted GROUP BY transaction_id HAVING SUM(amount) <> 0"""))
def _unbalanced(spark, sf_dir):
    ledger = staging_live_rows(b.faulted_ledger(spark, sf_dir))
    df = q.unbalanced_transactions(ledger)
    return df.withColumn("unbalanced_amount", F.col("unbalanced_amount").cast(SUM))


@query("grain_violations", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def _grain(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    df = q.grain_violations(lines, ["l_orderkey", "l_linenumber"])
    return df.withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))


@query("not_null_violations", with_tables("f_accounts f_transactions", """
SELECT 'accounts.partner_id' AS column_name, COUNT(*) AS failures FROM f_accounts
WHERE partner_id IS NULL HAVING COUNT(*) > 0
UNION ALL SELECT 'accounts.currency', COUNT(*) FROM f_accounts WHERE currency IS NULL HAVING COUNT(*) > 0
UNION ALL SELECT 'transactions.currency', COUNT(*) FROM f_transactions
WHERE currency IS NULL HAVING COUNT(*) > 0"""))
def _not_null(spark, sf_dir):
    checked = {
        "accounts": (b.faulted_accounts, ["account_id", "partner_id", "currency"]),
        "transactions": (b.faulted_transactions, ["transaction_id", "amount", "currency"]),
    }
    parts = [
        q.not_null_violations(make(spark, sf_dir), columns).withColumn(
            "column_name", F.concat(F.lit(f"{name}."), F.col("column_name"))
        )
        for name, (make, columns) in checked.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("unique_violations", """
SELECT CAST(o_custkey AS VARCHAR) AS value, COUNT(*) AS n_records FROM orders
WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1""")
def _unique(spark, sf_dir):
    return q.unique_violations(b.table(spark, sf_dir, "orders"), "o_custkey")


@query("accepted_value_violations", with_tables("f_accounts f_partners", """
SELECT 'currency' AS column_name, currency AS value, COUNT(*) AS n_records FROM f_accounts
WHERE currency NOT IN ('USD','CAD','BRL','EUR','GBP','JPY','CHF') GROUP BY 2
UNION ALL SELECT 'account_type', account_type, COUNT(*) FROM f_accounts
WHERE account_type NOT IN ('settlement','holding','fee') GROUP BY 2
UNION ALL SELECT 'status', status, COUNT(*) FROM f_accounts
WHERE status NOT IN ('active','frozen','closed') GROUP BY 2
UNION ALL SELECT 'partner_type', partner_type, COUNT(*) FROM f_partners
WHERE partner_type NOT IN ('merchant','bank','processor') GROUP BY 2"""))
def _accepted(spark, sf_dir):
    accounts = q.accepted_value_violations(b.faulted_accounts(spark, sf_dir), {
        "currency": CURRENCIES, "account_type": ACCOUNT_TYPES, "status": ACCOUNT_STATUSES,
    })
    partners = q.accepted_value_violations(
        b.faulted_partners(spark, sf_dir), {"partner_type": PARTNER_TYPES}
    )
    return accounts.unionByName(partners)


def _with_methods(spark, sf_dir: str) -> DataFrame:
    number, methods = F.col("transaction_id"), CONTRACTS["transactions"].domains["payment_method"]
    method = F.get(F.array(*[F.lit(m) for m in methods]), (number % len(methods)).cast("int"))
    return b.transactions(spark, sf_dir).withColumn("payment_method", F.when(number % 131 == 0, "cheque").otherwise(method))


@query("source_domain_violations", with_tables(
    "f_accounts f_partners b_payment_events b_transactions f_ledger", """
SELECT 'partners' AS "table", 'partner_type' AS column_name, partner_type AS value, COUNT(*) AS n_records
FROM f_partners WHERE partner_type NOT IN ('merchant','bank','processor') GROUP BY 3
UNION ALL SELECT 'partners', 'status', status, COUNT(*) FROM f_partners
WHERE status NOT IN ('active','suspended','inactive') GROUP BY 3
UNION ALL SELECT 'accounts', 'account_type', account_type, COUNT(*) FROM f_accounts
WHERE account_type NOT IN ('settlement','holding','fee') GROUP BY 3
UNION ALL SELECT 'accounts', 'status', status, COUNT(*) FROM f_accounts
WHERE status NOT IN ('active','frozen','closed') GROUP BY 3
UNION ALL SELECT 'transactions', 'status', status, COUNT(*) FROM b_transactions
WHERE status NOT IN ('pending','authorized','completed','voided','refunded') GROUP BY 3
UNION ALL SELECT 'transactions', 'payment_method', 'cheque', COUNT(*)
FROM b_transactions WHERE transaction_id % 131 = 0 HAVING COUNT(*) > 0
UNION ALL SELECT 'payment_events', 'event_type', event_type, COUNT(*) FROM b_payment_events
WHERE event_type NOT IN ('initiated','authorized','captured','settled','voided','refunded','chargeback') GROUP BY 3
UNION ALL SELECT 'ledger_entries', 'entry_type', entry_type, COUNT(*) FROM f_ledger
WHERE entry_type NOT IN ('debit','credit') GROUP BY 3"""))
def _source_domains(spark, sf_dir):
    tables = {
        "partners": b.faulted_partners, "accounts": b.faulted_accounts,
        "transactions": _with_methods, "payment_events": b.payment_events,
        "ledger_entries": b.faulted_ledger,
    }
    parts = []
    for name, make in tables.items():
        df = make(spark, sf_dir)
        domains = CONTRACTS[name].domains
        parts.append(
            q.accepted_value_violations(df, domains).select(F.lit(name).alias("table"), "*")
        )
    return reduce(DataFrame.unionByName, parts)


def _report_sql() -> str:
    def count(name: str, source: str) -> str:
        return f"SELECT '{name}' AS test, COUNT(*) AS failures FROM {source}"

    p, a, c, v, n = "f_partners", "f_accounts", "dim_currencies", "fct_volume", "fct_position"
    rows = [count("not_null:dim_partners.partner_id", f"{p} WHERE partner_id IS NULL")]
    for shown, column in (("account_id",) * 2, ("partner_id",) * 2, ("account_currency", "currency")):
        rows.append(count(f"not_null:dim_accounts.{shown}", f"{a} WHERE {column} IS NULL"))
    rows.append(count("not_null:dim_currencies.currency_code", f"{c} WHERE currency_code IS NULL"))
    for shown, column in (
        ("transaction_date", "d"), ("currency_code",) * 2, ("transaction_count", "n"),
        ("gross_volume", "v"),
    ):
        rows.append(count(f"not_null:fct_daily_volume.{shown}", f"{v} WHERE {column} IS NULL"))
    for column in ("partner_id", "currency_code", "entry_count", "total_debits", "total_credits",
                   "net_position"):
        rows.append(
            count(f"not_null:fct_partner_net_position.{column}", f"{n} WHERE {column} IS NULL")
        )
    for shown, source, column in (
        ("dim_partners.partner_id", p, "partner_id"), ("dim_accounts.account_id", a, "account_id"),
        ("dim_currencies.currency_code", c, "currency_code"),
    ):
        rows.append(count(
            f"unique:{shown}",
            f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)",
        ))
    for shown, source, column, values in (
        ("dim_partners.partner_type", p, "partner_type", "'merchant','bank','processor'"),
        ("dim_partners.status", p, "status", "'active','suspended','inactive'"),
        ("dim_accounts.account_currency", a, "currency", "'USD','CAD','BRL','EUR','GBP','JPY','CHF'"),
        ("dim_accounts.account_type", a, "account_type", "'settlement','holding','fee'"),
        ("dim_accounts.status", a, "status", "'active','frozen','closed'"),
    ):
        rows.append(count(
            f"accepted_values:{shown}",
            f"(SELECT DISTINCT {column} FROM {source} WHERE {column} NOT IN ({values}))",
        ))
    for shown, child, column, parent, key in (
        ("dim_accounts.partner_id", a, "partner_id", p, "partner_id"),
        ("fct_daily_volume.currency_code", v, "currency_code", c, "currency_code"),
        ("fct_partner_net_position.partner_id", n, "partner_id", p, "partner_id"),
        ("fct_partner_net_position.currency_code", n, "currency_code", c, "currency_code"),
    ):
        rows.append(count(
            f"relationships:{shown}", f"{child} WHERE {column} NOT IN (SELECT {key} FROM {parent})"
        ))
    rows.append(count("unique_grain:fct_daily_volume",
                      f"(SELECT 1 FROM {v} GROUP BY d, currency_code HAVING COUNT(*) > 1)"))
    rows.append(count("unique_grain:fct_partner_net_position",
                      f"(SELECT 1 FROM {n} GROUP BY partner_id, currency_code HAVING COUNT(*) > 1)"))
    rows.append(count("ledger_entries_have_account",
                      f"f_ledger l WHERE NOT _cdc_deleted AND NOT EXISTS "
                      f"(SELECT 1 FROM {a} x WHERE x.account_id = l.account_id)"))
    rows.append(count("ledger_entries_sum_to_zero",
                      "(SELECT 1 FROM f_ledger WHERE NOT _cdc_deleted GROUP BY transaction_id "
                      "HAVING SUM(amount) <> 0)"))
    rows.append(count("daily_volume_matches_state",
                      "expected_volume s FULL OUTER JOIN fct_volume g ON s.d = g.d AND "
                      "s.currency_code = g.currency_code WHERE COALESCE(s.n, 0) <> COALESCE(g.n, 0) "
                      "OR COALESCE(s.v, 0) <> COALESCE(g.v, 0)"))
    rows.append(count("net_position_matches_ledger",
                      "by_currency b FULL OUTER JOIN fact_by_currency f "
                      f"ON b.currency_code = f.currency_code WHERE {POSITION_DIFFERS}"))
    ctes = ", ".join([F_POSITIONS, F_CURRENCIES, F_VOLUME, F_EXPECTED_VOLUME, F_BY_CURRENCY])
    return f"WITH {ctes}\n" + "\nUNION ALL ".join(rows)


@query("quality_report", with_tables(
    "f_ledger f_accounts f_partners f_transactions", _report_sql()))
def _quality_report(spark, sf_dir):
    # As in the pipeline: the models are written, and their column tests are observed meanwhile.
    models, staging = faulted_models(spark, sf_dir)
    run, models = new_run_folder(spark, "gold"), {name: observed(name, df) for name, df in models.items()}
    with ThreadPoolExecutor(len(models)) as pool:
        list(pool.map(inheritable_thread_target(spark)(lambda name: models[name][0].write.parquet(f"{run}/{name}")), models))
    tables = {name: spark.read.schema(df.schema).parquet(f"{run}/{name}") for name, (df, _) in models.items()}
    return gold_quality_report(tables, staging, passed=passed_tests(seen for _, seen in models.values()))
