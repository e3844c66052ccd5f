"""Named queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallylake.session import SESSION_ZONE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
            return function(spark, sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


# --- the derived tables in SQL ---------------------------------------------------------

CTES = {
    "b_partners": """
SELECT CAST(n.n_nationkey AS BIGINT) AS partner_id, n.n_name AS name, r.r_name AS country,
  CASE n.n_nationkey % 3 WHEN 0 THEN 'merchant' WHEN 1 THEN 'bank' ELSE 'processor' END AS partner_type,
  CASE WHEN n.n_nationkey % 10 = 9 THEN 'suspended' ELSE 'active' END AS status, FALSE AS _cdc_deleted
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "b_accounts": """
SELECT c_custkey AS account_id, CAST(c_nationkey AS BIGINT) AS partner_id,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'USD' WHEN 'MACHINERY' THEN 'BRL' WHEN 'BUILDING' THEN 'EUR'
                    WHEN 'AUTOMOBILE' THEN 'GBP' ELSE 'JPY' END AS currency,
  CASE c_custkey % 3 WHEN 0 THEN 'settlement' WHEN 1 THEN 'holding' ELSE 'fee' END AS account_type,
  CASE WHEN c_acctbal < 0 THEN 'frozen' ELSE 'active' END AS status, FALSE AS _cdc_deleted
FROM customer""",
    "b_transactions": """
SELECT o.o_orderkey AS transaction_id, o.o_custkey AS source_account_id,
  (o.o_custkey * 7 + 13) % (SELECT COUNT(*) FROM customer) AS destination_account_id,
  CAST(o.o_totalprice AS DECIMAL(18,4)) AS amount, a.currency AS currency,
  CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'authorized' END AS status,
  o.o_orderdate AS created_at, o.o_orderkey AS _cdc_lsn, (o.o_orderkey % 50 = 0) AS _cdc_deleted
FROM orders o JOIN b_accounts a ON o.o_custkey = a.account_id""",
    "b_ledger_entries": """
SELECT transaction_id * 2 AS entry_id, transaction_id, source_account_id AS account_id, 'debit' AS entry_type,
  amount, currency, created_at, _cdc_lsn, _cdc_deleted FROM b_transactions
UNION ALL
SELECT transaction_id * 2 + 1, transaction_id, destination_account_id, 'credit',
  CAST(-amount AS DECIMAL(18,4)), currency, created_at, _cdc_lsn, _cdc_deleted FROM b_transactions""",
    "b_payment_events": """
SELECT event_id, user_id AS transaction_id, event_type, props AS metadata, ts AS created_at,
  event_id AS _cdc_lsn, event_type = 'error' AS _cdc_deleted FROM events""",
    "f_partners": """
SELECT partner_id, name, country,
  CASE WHEN partner_id % 11 = 0 THEN 'broker' ELSE partner_type END AS partner_type, status, _cdc_deleted
FROM b_partners""",
    "f_accounts": """
SELECT account_id,
  CASE WHEN account_id % 109 = 0 THEN NULL WHEN account_id % 107 = 0 THEN partner_id + 1000
       ELSE partner_id END AS partner_id,
  CASE WHEN account_id % 103 = 0 THEN NULL WHEN account_id % 101 = 0 THEN 'XXX'
       ELSE currency END AS currency,
  CASE WHEN account_id % 113 = 0 THEN 'escrow' ELSE account_type END AS account_type,
  CASE WHEN account_id % 127 = 0 THEN 'dormant' ELSE status END AS status, _cdc_deleted
FROM b_accounts""",
    "f_transactions": """
SELECT transaction_id, source_account_id, destination_account_id,
  CASE WHEN transaction_id % 97 = 0 THEN CAST(amount + 1 AS DECIMAL(18,4)) ELSE amount END AS amount,
  CASE WHEN transaction_id % 1009 = 0 THEN NULL ELSE currency END AS currency,
  status, created_at, _cdc_lsn, _cdc_deleted
FROM b_transactions""",
    "f_ledger": """
SELECT entry_id, transaction_id,
  CASE WHEN entry_id % 89 = 0 THEN account_id + 1000000 ELSE account_id END AS account_id, entry_type,
  CASE WHEN entry_id % 97 = 0 THEN CAST(amount + 1 AS DECIMAL(18,4)) ELSE amount END AS amount,
  currency, created_at, _cdc_lsn, _cdc_deleted
FROM b_ledger_entries""",
}
_NEEDS = {
    "b_transactions": ["b_accounts"],
    "b_ledger_entries": ["b_transactions"],
    "f_partners": ["b_partners"],
    "f_accounts": ["b_accounts"],
    "f_transactions": ["b_transactions"],
    "f_ledger": ["b_ledger_entries"],
}


def with_tables(names: str, sql: str) -> str:
    """``sql`` behind the WITH list of the named derived tables and what they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    body = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in ordered)
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return f"WITH {body},\n{sql[5:]}"
    return f"WITH {body}\n{sql}"


def dashed_md5(text: str) -> str:
    """SQL for the dashed lowercase MD5 of an SQL text expression."""
    h = f"md5({text})"
    parts = [f"substr({h}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return "(" + " || '-' || ".join(parts) + ")"
