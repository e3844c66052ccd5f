"""Staging, dimensions, facts, joins, aggregates and windows over the finance tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.checks import bindings as b
from tallylake.checks.registry import query, with_tables
from tallylake.contracts import LSN
from tallylake.operators import reconcile as r
from tallylake.plans import gold
from tallylake.plans.staging import staging_live_rows

SUM = "decimal(28,4)"
STATES = {
    "partners": b.partners, "accounts": b.accounts, "transactions": b.transactions,
    "payment_events": b.payment_events, "ledger_entries": b.ledger_entries,
}


def stg(name: str, spark, sf_dir: str) -> DataFrame:
    return staging_live_rows(STATES[name](spark, sf_dir))


def positions(spark, sf_dir: str) -> DataFrame:
    accounts = gold.dim_accounts(stg("accounts", spark, sf_dir))
    return gold.partner_net_position(stg("ledger_entries", spark, sf_dir), accounts)


def position_columns(df: DataFrame) -> list:
    sums = ("total_debits", "total_credits", "net_position")
    return [F.col(c).cast(SUM).alias(c) if c in sums else F.col(c) for c in df.columns]


LIVE_POSITIONS = """positions AS (
SELECT a.partner_id, l.currency AS currency_code, COUNT(*) AS entry_count,
  CAST(SUM(CASE WHEN entry_type = 'debit' THEN amount ELSE 0 END) AS DECIMAL(28,4)) AS total_debits,
  CAST(SUM(CASE WHEN entry_type = 'credit' THEN -amount ELSE 0 END) AS DECIMAL(28,4)) AS total_credits,
  CAST(-SUM(amount) AS DECIMAL(28,4)) AS net_position
FROM b_ledger_entries l JOIN b_accounts a ON l.account_id = a.account_id
WHERE NOT l._cdc_deleted GROUP BY a.partner_id, l.currency)"""


@query("staging_live_rows", with_tables(
    "b_partners b_accounts b_transactions b_ledger_entries b_payment_events", """
SELECT 'accounts' AS model, account_id AS id, currency AS code FROM b_accounts WHERE NOT _cdc_deleted
UNION ALL SELECT 'ledger_entries', entry_id, entry_type FROM b_ledger_entries WHERE NOT _cdc_deleted
UNION ALL SELECT 'partners', partner_id, partner_type FROM b_partners WHERE NOT _cdc_deleted
UNION ALL SELECT 'payment_events', event_id, event_type FROM b_payment_events WHERE NOT _cdc_deleted
UNION ALL SELECT 'transactions', transaction_id, status FROM b_transactions WHERE NOT _cdc_deleted"""))
def _staging(spark, sf_dir):
    shown = {
        "accounts": ("account_id", "currency"), "ledger_entries": ("entry_id", "entry_type"),
        "partners": ("partner_id", "partner_type"), "payment_events": ("event_id", "event_type"),
        "transactions": ("transaction_id", "status"),
    }
    parts = [
        stg(name, spark, sf_dir).select(
            F.lit(name).alias("model"), F.col(key).alias("id"), F.col(code).alias("code")
        )
        for name, (key, code) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("dim_accounts", with_tables("b_accounts", """
SELECT account_id, partner_id, currency AS account_currency, account_type, status
FROM b_accounts WHERE NOT _cdc_deleted"""))
def _dim_accounts(spark, sf_dir):
    return gold.dim_accounts(stg("accounts", spark, sf_dir)).drop("created_at", "updated_at")


@query("dim_partners", with_tables("b_partners", """
SELECT partner_id, name AS partner_name, country AS country_code, partner_type, status
FROM b_partners WHERE NOT _cdc_deleted"""))
def _dim_partners(spark, sf_dir):
    return gold.dim_partners(stg("partners", spark, sf_dir)).drop("created_at", "updated_at")


@query("dim_currencies", with_tables("f_accounts", """
SELECT DISTINCT currency AS currency_code FROM f_accounts WHERE currency IS NOT NULL"""))
def _dim_currencies(spark, sf_dir):
    staged = staging_live_rows(b.faulted_accounts(spark, sf_dir))
    return gold.dim_currencies(gold.dim_accounts(staged))


@query("completed_transactions", with_tables("b_transactions", """
SELECT strftime(created_at, '%Y-%m-%d') AS transaction_date, transaction_id,
  currency AS currency_code, amount
FROM b_transactions WHERE status = 'completed' AND NOT _cdc_deleted"""))
def _completed(spark, sf_dir):
    df = gold.completed_transactions(stg("transactions", spark, sf_dir))
    return df.withColumn("transaction_date", F.col("transaction_date").cast("string"))


@query("daily_volume", with_tables("b_transactions", """
SELECT strftime(created_at, '%Y-%m-%d') AS transaction_date, currency AS currency_code,
  COUNT(DISTINCT transaction_id) AS transaction_count, CAST(SUM(amount) AS DECIMAL(28,4)) AS gross_volume
FROM b_transactions WHERE status = 'completed' AND NOT _cdc_deleted GROUP BY 1, 2"""))
def _daily_volume(spark, sf_dir):
    return gold.daily_volume(stg("transactions", spark, sf_dir)).select(
        F.col("transaction_date").cast("string").alias("transaction_date"), "currency_code",
        "transaction_count", F.col("gross_volume").cast(SUM).alias("gross_volume"),
    )


@query("ledger_with_partner", with_tables("f_ledger b_accounts", """
SELECT a.partner_id, l.currency AS currency_code, l.entry_type, l.amount
FROM f_ledger l JOIN b_accounts a ON l.account_id = a.account_id WHERE NOT l._cdc_deleted"""))
def _ledger_with_partner(spark, sf_dir):
    accounts = gold.dim_accounts(stg("accounts", spark, sf_dir))
    return gold.ledger_with_partner(staging_live_rows(b.faulted_ledger(spark, sf_dir)), accounts)


@query("signed_amounts", with_tables("b_ledger_entries", """
SELECT entry_id, CAST(CASE WHEN entry_type = 'debit' THEN amount ELSE 0 END AS DECIMAL(18,4)) AS debit_amount,
  CAST(CASE WHEN entry_type = 'credit' THEN -amount ELSE 0 END AS DECIMAL(18,4)) AS credit_amount
FROM b_ledger_entries WHERE NOT _cdc_deleted"""))
def _signed(spark, sf_dir):
    signed = gold.signed_amounts(stg("ledger_entries", spark, sf_dir))
    return signed.select("entry_id", "debit_amount", "credit_amount")


@query("partner_net_position", with_tables(
    "b_ledger_entries", f"WITH {LIVE_POSITIONS} SELECT * FROM positions"))
def _net_position(spark, sf_dir):
    df = positions(spark, sf_dir)
    return df.select(*position_columns(df))


@query("position_with_partner", with_tables("b_ledger_entries b_partners", f"""
WITH {LIVE_POSITIONS}
SELECT f.*, p.name AS partner_name FROM positions f JOIN b_partners p ON f.partner_id = p.partner_id"""))
def _position_with_partner(spark, sf_dir):
    partners = gold.dim_partners(stg("partners", spark, sf_dir))
    df = gold.position_with_partner(positions(spark, sf_dir), partners)
    return df.select(*position_columns(df))


TOP = f"""
WITH {LIVE_POSITIONS}, ranked AS (
SELECT f.currency_code, p.name AS partner_name, f.total_debits, f.total_credits, f.net_position,
  ROW_NUMBER() OVER (PARTITION BY f.currency_code ORDER BY f.net_position DESC, f.partner_id) AS position_ranking
FROM positions f JOIN b_partners p ON f.partner_id = p.partner_id WHERE f.net_position > 0)
SELECT currency_code, partner_name, total_debits, total_credits, net_position,
  CAST(position_ranking AS BIGINT) AS position_ranking
FROM ranked WHERE position_ranking <= 3"""


@query("top_positions", with_tables("b_ledger_entries b_partners", TOP))
def top_positions(spark, sf_dir):
    partners = gold.dim_partners(stg("partners", spark, sf_dir))
    df = gold.top_positions(positions(spark, sf_dir), partners)
    df = df.withColumn("position_ranking", F.col("position_ranking").cast("bigint"))
    return df.select(*position_columns(df))


@query("position_rollup", with_tables("b_ledger_entries", """
SELECT l.currency AS currency_code, COUNT(*) AS entry_count,
  CAST(SUM(CASE WHEN entry_type = 'debit' THEN amount ELSE 0 END) AS DECIMAL(28,4)) AS total_debits,
  CAST(SUM(CASE WHEN entry_type = 'credit' THEN -amount ELSE 0 END) AS DECIMAL(28,4)) AS total_credits,
  CAST(-SUM(amount) AS DECIMAL(28,4)) AS net_position
FROM b_ledger_entries l JOIN b_accounts a ON l.account_id = a.account_id
WHERE NOT l._cdc_deleted GROUP BY l.currency"""))
def _rollup(spark, sf_dir):
    df = gold.position_rollup(positions(spark, sf_dir))
    return df.select(*position_columns(df))


@query("active_counts", with_tables(
    "b_partners b_accounts b_transactions b_ledger_entries b_payment_events", """
SELECT 'partners' AS "table", COUNT(*) FILTER (WHERE NOT _cdc_deleted) AS live_rows FROM b_partners
UNION ALL SELECT 'accounts', COUNT(*) FILTER (WHERE NOT _cdc_deleted) FROM b_accounts
UNION ALL SELECT 'transactions', COUNT(*) FILTER (WHERE NOT _cdc_deleted) FROM b_transactions
UNION ALL SELECT 'payment_events', COUNT(*) FILTER (WHERE NOT _cdc_deleted) FROM b_payment_events
UNION ALL SELECT 'ledger_entries', COUNT(*) FILTER (WHERE NOT _cdc_deleted) FROM b_ledger_entries"""))
def _active_counts(spark, sf_dir):
    return r.active_counts({name: make(spark, sf_dir) for name, make in STATES.items()})


@query("ledger_total", with_tables("f_ledger", """
SELECT CAST(COALESCE(SUM(amount), 0) AS DECIMAL(38,4)) AS ledger_total
FROM f_ledger WHERE NOT _cdc_deleted"""))
def _ledger_total(spark, sf_dir):
    return r.ledger_total(b.faulted_ledger(spark, sf_dir))


@query("max_lsn", with_tables("b_transactions b_ledger_entries b_payment_events b_accounts b_partners", """
SELECT 'transactions' AS "table", MAX(_cdc_lsn) AS max_lsn FROM b_transactions
UNION ALL SELECT 'payment_events', MAX(_cdc_lsn) FROM b_payment_events
UNION ALL SELECT 'ledger_entries', MAX(_cdc_lsn) FROM b_ledger_entries
UNION ALL SELECT 'accounts', MAX(account_id) * 3 FROM b_accounts
UNION ALL SELECT 'partners', MAX(partner_id) * 5 FROM b_partners"""))
def _max_lsn(spark, sf_dir):
    return r.max_lsn(b.events_of_all(spark, sf_dir))


@query("source_snapshot_scan", with_tables("b_transactions b_ledger_entries", """
SELECT 'transactions' AS "table", COUNT(*) AS source_rows, CAST(SUM(amount) AS DECIMAL(28,4)) AS total
FROM b_transactions
UNION ALL SELECT 'ledger_entries', COUNT(*), CAST(SUM(amount) AS DECIMAL(28,4)) FROM b_ledger_entries"""))
def _source_snapshot(spark, sf_dir):
    # A Parquet table stands in for the database: there is no JDBC driver here.
    parts = [
        STATES[name](spark, sf_dir).agg(
            F.count(F.lit(1)).alias("source_rows"), F.sum("amount").cast(SUM).alias("total")
        ).select(F.lit(name).alias("table"), "source_rows", "total")
        for name in ("transactions", "ledger_entries")
    ]
    return reduce(DataFrame.unionByName, parts)
