"""Incremental progress, the whole pipeline, reconciliation, migration and finance jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.checks import bindings as b
from tallylake.checks import fixtures as x
from tallylake.checks.gold_queries import SUM
from tallylake.checks.registry import dashed_md5, query, with_tables
from tallylake.contracts import CONTRACTS, DELETED, LSN
from tallylake.operators import finance
from tallylake.operators import manifest as m
from tallylake.operators import reconcile as r
from tallylake.operators.migrate import migration_plan, preserve_legacy
from tallylake.operators.quality import stored_schema_diff
from tallylake.plans.jobs import landed_versions, reconcile_lake
from tallylake.session import COMPACT, new_run_folder, released_shuffles
from tallylake.sources import bronze
from tallylake.sources.tables import SilverTable, VersionedTable

TABLE_NAMES = list(CONTRACTS)

# --- manifests and checkpoints ---------------------------------------------------------

OBJECTS = """objects AS (SELECT
  'cdc.public.' || CASE o_orderstatus WHEN 'F' THEN 'transactions' WHEN 'O' THEN 'accounts' ELSE 'unknown' END AS topic,
  o_orderkey % 3 AS "partition", o_orderkey AS start_offset,
  CASE o_orderstatus WHEN 'F' THEN 'transactions' WHEN 'O' THEN 'accounts' ELSE 'unknown' END AS "table",
  o_orderdate AS d FROM orders
WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0)"""
URI = """'s3://bronze/topics/' || topic || strftime(d, '/year=%Y/month=%m/day=%d/') || topic || '+' ||
  "partition" || '+' || lpad(CAST(start_offset AS VARCHAR), 10, '0') || '.json'"""
HALF = """half AS (SELECT topic, "partition", MAX(start_offset) // 2 AS last_offset FROM objects
WHERE "partition" <> 2 GROUP BY 1, 2)"""
SELECTED = """selected AS (SELECT o.* FROM objects o LEFT JOIN half h
ON o.topic = h.topic AND o."partition" = h."partition" WHERE o.start_offset > COALESCE(h.last_offset, -1))"""


def objects(spark, sf_dir) -> DataFrame:
    return m.parse_bronze_keys(x.object_keys(spark, sf_dir))


def selected(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(checkpoints, new objects)."""
    found = objects(spark, sf_dir)
    half = x.half_checkpoints(found)
    return half, m.unprocessed_objects(found, half)


@query("list_bronze_objects", f"""
WITH bodies AS (SELECT event_id // {x.SNAPSHOT_SPAN} AS block, SUM(length(CAST(epoch_us(date_trunc('second', ts)) // 1000000 AS VARCHAR)) * 2
  + length(event_type) + length(CAST(value AS VARCHAR)) + length(CAST(user_id AS VARCHAR))
  + CASE event_type WHEN 'click' THEN 2 WHEN 'signup' THEN 2 ELSE 0 END
  + length('["123456"," ","Brazil",,,-46.625,-23.5,731.5,false,,268.5,-3.25,[,7],777.5,null,false,0]') - 1 + 1) AS size,
  COUNT(*) AS n FROM events GROUP BY 1)
SELECT 'snap-' || block AS snapshot, CAST(size + n - 1
  + length('{{"time":,"states":[]}}') + 10 + 1 AS BIGINT) AS length FROM bodies""")
def _list_objects(spark, sf_dir):
    folder = x.snapshot_folder(spark, sf_dir)
    found = bronze.list_bronze_objects(spark, folder)
    name = F.regexp_extract("key", r"^dt=[^/]+/hour=[^/]+/snapshot_id=([^/]+)/", 1)
    return found.select(name.alias("snapshot"), "length")


@query("parse_bronze_keys", f"""WITH {OBJECTS}
SELECT topic, "partition", start_offset, "table", {URI} AS uri FROM objects""")
def _parse(spark, sf_dir):
    return objects(spark, sf_dir).drop("key")


@query("unprocessed_objects", f"""WITH {OBJECTS}, {HALF}, {SELECTED}
SELECT topic, "partition", start_offset, "table" FROM selected""")
def _unprocessed(spark, sf_dir):
    return selected(spark, sf_dir)[1].drop("key", "uri")


@query("batch_manifest", f"""WITH {OBJECTS}, {HALF}, {SELECTED}
SELECT "table", "table" <> 'unknown' AS has_contract, topic, "partition", start_offset, {URI} AS uri
FROM selected""")
def _manifest(spark, sf_dir):
    return m.batch_manifest(selected(spark, sf_dir)[1], TABLE_NAMES)


@query("manifest_order", f"""WITH {OBJECTS}
SELECT topic, "partition", start_offset,
  CAST(ROW_NUMBER() OVER (ORDER BY topic, "partition", start_offset) AS BIGINT) AS position FROM objects""")
def _order(spark, sf_dir):
    found = objects(spark, sf_dir).select("key", "topic", "partition", "start_offset")
    return m.manifest_order(found, new_run_folder(spark, "manifest-order")).drop("key")


@query("next_checkpoints", f"""WITH {OBJECTS}, {HALF}, {SELECTED}
SELECT topic, "partition", MAX(o) AS last_offset FROM (
  SELECT topic, "partition", last_offset AS o FROM half
  UNION ALL SELECT topic, "partition", start_offset FROM selected) GROUP BY 1, 2""")
def _next(spark, sf_dir):
    return m.next_checkpoints(*selected(spark, sf_dir))


@query("has_new_files", """
SELECT COUNT(*) > 0 AS before_commit, FALSE AS after_commit FROM orders
WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 19 <> 0""")
def _has_new(spark, sf_dir):
    found = objects(spark, sf_dir)
    half, new = selected(spark, sf_dir)
    rest = m.unprocessed_objects(found, m.next_checkpoints(half, new))
    return spark.range(1).select(
        F.lit(m.has_new_files(new)).alias("before_commit"),
        F.lit(m.has_new_files(rest)).alias("after_commit"),
    )


@query("capture_cutoff", with_tables("b_transactions b_ledger_entries b_payment_events b_accounts b_partners", """
SELECT MAX(lsn) AS cutoff_lsn FROM (SELECT MAX(_cdc_lsn) AS lsn FROM b_transactions
UNION ALL SELECT MAX(_cdc_lsn) FROM b_ledger_entries UNION ALL SELECT MAX(_cdc_lsn) FROM b_payment_events
UNION ALL SELECT MAX(account_id) * 3 FROM b_accounts UNION ALL SELECT MAX(partner_id) * 5 FROM b_partners)"""))
def _capture(spark, sf_dir):
    return r.capture_cutoff(b.events_of_all(spark, sf_dir))


@query("commit_checkpoint", """
WITH previous AS (SELECT MAX(o_orderkey) AS lsn FROM orders WHERE o_orderstatus = 'F'),
batches AS (SELECT o_orderstatus AS status, MAX(o_orderkey) AS lsn FROM orders GROUP BY 1)
SELECT status, p.lsn AS previous_lsn, b.lsn AS batch_lsn, b.lsn >= p.lsn AS committed
FROM batches b, previous p""")
def _commit(spark, sf_dir):
    # One decision per order status against the last LSN of finished orders.
    orders = b.table(spark, sf_dir, "orders")
    lsn = F.max("o_orderkey").alias("lsn")
    previous = orders.where("o_orderstatus = 'F'").agg(lsn)
    statuses = [row[0] for row in orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]
    parts = [
        m.commit_decision(previous, orders.where(F.col("o_orderstatus") == status).agg(lsn)).select(
            F.lit(status).alias("status"), "*"
        )
        for status in statuses
    ]
    return reduce(DataFrame.unionByName, parts)


# --- the whole pipeline ----------------------------------------------------------------

def _per_table(column: str, sql: str) -> str:
    sources = {
        "partners": "b_partners", "accounts": "b_accounts", "transactions": "b_transactions",
        "payment_events": "b_transactions", "ledger_entries": "b_ledger_entries",
    }
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS {column}, {sql} FROM {source}" for name, source in sources.items()
    )


LAKE_TABLES = "b_partners b_transactions b_ledger_entries"


APPLIED = with_tables(LAKE_TABLES, _per_table('"table"', """
COUNT(*) FILTER (WHERE NOT _cdc_deleted) AS live_rows, COUNT(*) FILTER (WHERE _cdc_deleted) AS deleted_rows,
COUNT(*) AS applied_first, COUNT(*) AS applied_second, CAST(0 AS BIGINT) AS ignored_second"""))


@query("run_microbatch", APPLIED)
def _run(spark, sf_dir):
    return _applied(x.finished_lake(spark, sf_dir))


@query("run_landed_microbatch", APPLIED)
def _run_landed(spark, sf_dir):
    return _applied(x.landed_lake(spark, sf_dir))


def _applied(done: x.FinishedLake) -> DataFrame:
    first, second = (result.applied for result in done.results)
    parts = [
        done.lake.silver(name).read([DELETED]).agg(
            F.count_if(~F.col(DELETED)).alias("live_rows"),
            F.count_if(F.col(DELETED)).alias("deleted_rows"),
        ).select(
            F.lit(name).alias("table"), "*",
            F.lit(first[name][0]).cast("bigint").alias("applied_first"),
            F.lit(second[name][0]).cast("bigint").alias("applied_second"),
            F.lit(second[name][1]).cast("bigint").alias("ignored_second"),
        )
        for name in TABLE_NAMES
    ]
    return reduce(DataFrame.unionByName, parts)


@query("materialize_gold", with_tables("b_transactions", """
SELECT strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * CAST(transaction_id % 28 AS INT), '%Y-%m-%d') AS transaction_date,
  currency AS currency_code, COUNT(*) AS transaction_count, CAST(SUM(amount) AS DECIMAL(28,4)) AS gross_volume
FROM b_transactions WHERE status = 'completed' AND NOT _cdc_deleted GROUP BY 1, 2"""))
def _materialized(spark, sf_dir):
    fact = x.finished_lake(spark, sf_dir).lake.gold("fct_daily_volume").read()
    return fact.select(
        F.col("transaction_date").cast("string").alias("transaction_date"), "currency_code",
        "transaction_count", F.col("gross_volume").cast(SUM).alias("gross_volume"),
    )


ENTRY_KEY = dashed_md5("'entry:' || entry_id")


@query("scan_silver_projected", with_tables("b_ledger_entries", f"""
SELECT {ENTRY_KEY} AS entry_id, entry_id + 1 + {x.SECOND_LSN} AS _cdc_lsn
FROM b_ledger_entries WHERE NOT _cdc_deleted"""))
def _projected(spark, sf_dir):
    table = x.finished_lake(spark, sf_dir).lake.silver("ledger_entries")
    return table.read(["entry_id", LSN], live_only=True)


@query("write_day_partitioned", with_tables("b_transactions", """
SELECT strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * CAST(transaction_id % 28 AS INT), '%Y-%m-%d') AS day,
  COUNT(*) AS transactions, CAST(SUM(amount) AS DECIMAL(28,4)) AS amount
FROM b_transactions WHERE NOT _cdc_deleted GROUP BY 1"""))
def _day_partitioned(spark, sf_dir):
    state = x.finished_lake(spark, sf_dir).lake.silver("transactions").read()
    table = SilverTable(spark, new_run_folder(spark, "silver"), CONTRACTS["transactions"])
    with released_shuffles(spark):
        write = table.write_state(state, "created_at")
    table.publish(write)
    # The days are read from the folder names alone.
    return (
        spark.read.parquet(table.folder(write))
        .where(~F.col(DELETED))
        .groupBy(F.col("created_at_day").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("transactions"), F.sum("amount").cast(SUM).alias("amount"))
    )


# --- reconciliation --------------------------------------------------------------------

@query("reconcile_layers", with_tables(LAKE_TABLES, f"""
{_per_table('item', "CAST(COUNT(*) FILTER (WHERE NOT _cdc_deleted) AS DECIMAL(38,4)) AS source")
 .replace("AS source FROM", '''AS source,
CAST(COUNT(*) FILTER (WHERE NOT _cdc_deleted) AS DECIMAL(38,4)) AS bronze,
CAST(COUNT(*) FILTER (WHERE NOT _cdc_deleted) AS DECIMAL(38,4)) AS silver, TRUE AS in_sync FROM''')
 .replace("SELECT '", "SELECT 'rows:")}
UNION ALL SELECT 'ledger_total', CAST(SUM(amount) AS DECIMAL(38,4)), CAST(NULL AS DECIMAL(38,4)),
  CAST(SUM(amount) AS DECIMAL(38,4)), SUM(amount) = 0 FROM b_ledger_entries WHERE NOT _cdc_deleted"""))
def _layers(spark, sf_dir):
    done = x.finished_lake(spark, sf_dir)
    return reconcile_lake(done.lake, done.bronze, x.source_tables(spark, sf_dir))


@query("reconcile_cutoff", with_tables(LAKE_TABLES, f"""
SELECT 'rows:' || item AS item, bronze, silver, bronze = silver AS in_sync FROM (
{_per_table('item', '''CAST(COUNT(*) AS DECIMAL(38,4)) AS bronze,
CAST(COUNT(*) FILTER (WHERE NOT _cdc_deleted) AS DECIMAL(38,4)) AS silver''')})
UNION ALL SELECT 'ledger_total', CAST(SUM(amount) AS DECIMAL(38,4)),
  CAST(SUM(amount) FILTER (WHERE NOT _cdc_deleted) AS DECIMAL(38,4)), TRUE FROM b_ledger_entries"""))
def _at_cutoff(spark, sf_dir):
    # The cutoff of the first batch: the state has moved on, which must show.
    done = x.finished_lake(spark, sf_dir)
    return reconcile_lake(done.lake, done.bronze, cutoff=done.results[0].cutoff_lsn)


@query("reconcile_batch", with_tables(LAKE_TABLES, f"""
SELECT 'keys:' || item AS item, checked, CAST(0 AS BIGINT) AS failures, TRUE AS in_sync FROM (
{_per_table('item', "CAST(COUNT(*) AS DECIMAL(38,4)) AS checked")})
UNION ALL SELECT 'ledger_total', CAST(SUM(amount) AS DECIMAL(38,4)), CAST(0 AS BIGINT), TRUE
FROM b_ledger_entries WHERE NOT _cdc_deleted"""))
def _batch(spark, sf_dir):
    done, latest, run = x.finished_lake(spark, sf_dir), {}, new_run_folder(spark, "latest")
    lake = done.lake
    keys = {name: contract.primary_key for name, contract in CONTRACTS.items()}
    for name, df in landed_versions(lake, done.bronze).items():
        # Written as in the pipeline: the check reads a batch several times, and three columns of it.
        df = df.select(keys[name], LSN, DELETED)
        with released_shuffles(spark):
            df.write.options(**COMPACT).parquet(f"{run}/{name}")
        latest[name] = spark.read.schema(df.schema).parquet(f"{run}/{name}")
    stored = {n: lake.silver(n).near(df, [keys[n], LSN, DELETED]) for n, df in latest.items()}
    return r.reconcile_batch(latest, stored, keys, lake.silver("ledger_entries").read())


# --- contracts and migration -----------------------------------------------------------

def _old_lake(spark, sf_dir) -> str:
    """A lake whose transactions hold amounts as doubles and whose accounts lack a column."""
    done, root = x.finished_lake(spark, sf_dir), new_run_folder(spark, "old-lake")
    for name in TABLE_NAMES:
        state = done.lake.silver(name).read()
        if name == "transactions":
            state = state.withColumn("amount", F.col("amount").cast("double"))
        if name == "accounts":
            state = state.drop("updated_at")
        if name != "partners":
            with released_shuffles(spark):
                VersionedTable(spark, f"{root}/silver/{name}").replace(state)
    return root


AFFECTED = """(SELECT 'accounts' AS "table", COUNT(*) AS rows FROM customer UNION ALL SELECT 'transactions', COUNT(*) FROM orders) AS r"""


@query("schema_diff", f"""
SELECT "table", CAST(position AS BIGINT) AS position, actual, expected, rows FROM {AFFECTED} JOIN (VALUES
 ('accounts', 6, '_cdc_lsn bigint', 'updated_at timestamp'),
 ('accounts', 7, '_cdc_deleted boolean', '_cdc_lsn bigint required'),
 ('accounts', 8, NULL, '_cdc_deleted boolean required'),
 ('accounts', 0, 'account_id string', 'account_id string required'),
 ('transactions', 0, 'transaction_id string', 'transaction_id string required'),
 ('transactions', 3, 'amount double', 'amount decimal(18,4)'),
 ('transactions', 13, '_cdc_lsn bigint', '_cdc_lsn bigint required'),
 ('transactions', 14, '_cdc_deleted boolean', '_cdc_deleted boolean required'))
 AS d("table", position, actual, expected) USING ("table")""")
def _schema_diff(spark, sf_dir):
    root, parts = _old_lake(spark, sf_dir), []
    for name in ("accounts", "transactions"):
        diff = stored_schema_diff(spark, VersionedTable(spark, f"{root}/silver/{name}").read(), CONTRACTS[name].schema)
        parts.append(diff.select(F.lit(name).alias("table"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query("migration_plan", f"""
SELECT "table", source, target, CAST(differences AS BIGINT) AS differences, rows FROM {AFFECTED} JOIN (VALUES
 ('transactions', 'silver/transactions', 'silver_legacy/transactions_pre_contract_v2', 1),
 ('accounts', 'silver/accounts', 'silver_legacy/accounts_pre_contract_v2', 3))
 AS p("table", source, target, differences) USING ("table")""")
def _plan(spark, sf_dir):
    return migration_plan(spark, _old_lake(spark, sf_dir), CONTRACTS)


@query("preserve_legacy", with_tables("b_transactions", """
SELECT 'transactions' AS "table", COUNT(*) AS preserved_rows,
  CAST(SUM(amount) FILTER (WHERE NOT _cdc_deleted) AS DECIMAL(28,4)) AS amount FROM b_transactions
UNION ALL SELECT 'accounts', COUNT(*), NULL FROM b_accounts"""))
def _preserve(spark, sf_dir):
    root = _old_lake(spark, sf_dir)
    moved = preserve_legacy(spark, root, migration_plan(spark, root, CONTRACTS)).collect()
    parts = []
    for row in moved:
        kept = VersionedTable(spark, f"{root}/{row.target}").read()
        amount = F.sum(F.col("amount").cast("decimal(18,4)")) if "amount" in kept.columns else F.lit(None)
        parts.append(kept.agg(
            F.count(F.lit(1)).alias("preserved_rows"), amount.cast(SUM).alias("amount")
        ).select(F.lit(row.table).alias("table"), "*"))
    return reduce(DataFrame.unionByName, parts)


# --- finance jobs ----------------------------------------------------------------------

RATES = ", ".join(f"('{a}', '{c}', CAST('{rate}' AS DECIMAL(18,8)))" for a, c, rate in finance.FX_RATES)
FX_SQL = f"""WITH rates AS (SELECT * FROM (VALUES {RATES}) AS v(src, dst, rate)),
inverse AS (SELECT dst AS src, src AS dst,
  CAST(ROUND(1.0 / CAST(rate AS DOUBLE), 8) AS DECIMAL(18,8)) AS rate FROM rates),
pairs AS (SELECT t.transaction_id, t.amount, t.currency, a.currency AS dst FROM b_transactions t
  JOIN b_accounts a ON t.destination_account_id = a.account_id),
rated AS (SELECT p.*, CASE WHEN p.currency = p.dst THEN NULL ELSE COALESCE(d.rate, i.rate) END AS found FROM pairs p
  LEFT JOIN rates d ON p.currency = d.src AND p.dst = d.dst
  LEFT JOIN inverse i ON p.currency = i.src AND p.dst = i.dst)
SELECT transaction_id, CAST(COALESCE(found, 1) AS DECIMAL(18,8)) AS fx_rate,
  CAST(ROUND(CAST(amount AS DECIMAL(19,4)) * CAST(COALESCE(found, 1) AS DECIMAL(18,8)), 4) AS DECIMAL(18,4)) AS converted_amount,
  CASE WHEN found IS NULL THEN currency ELSE dst END AS converted_currency FROM rated"""


@query("fx_convert", with_tables("b_transactions", FX_SQL))
def _fx(spark, sf_dir):
    target = b.accounts(spark, sf_dir).select(
        F.col("account_id").alias("destination_account_id"),
        F.col("currency").alias("destination_currency"),
    )
    transfers = b.transactions(spark, sf_dir).join(target, "destination_account_id")
    return finance.fx_convert(transfers, finance.rate_table(spark)).select(
        "transaction_id", "fx_rate", "converted_amount", "converted_currency"
    )


@query("post_double_entry", with_tables("b_transactions", """
SELECT transaction_id, 'debit' AS entry_type, source_account_id AS account_id, amount,
  'Débito (saída) ' || currency AS description, currency FROM b_transactions
UNION ALL SELECT transaction_id, 'credit', destination_account_id, CAST(-amount AS DECIMAL(18,4)),
  'Crédito (entrada) ' || currency, currency FROM b_transactions"""))
def _double_entry(spark, sf_dir):
    return finance.post_double_entry(b.transactions(spark, sf_dir)).drop("created_at")


COUNTRY_SQL = "CASE {} % 8 " + " ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(finance.CURRENCY_OF_COUNTRY)) + " END"
CURRENCY_SQL = "CASE {} % 8 " + " ".join(
    f"WHEN {i} THEN '{c}'" for i, c in enumerate(finance.CURRENCY_OF_COUNTRY.values())) + " END"


@query("provision_accounts", f"""
SELECT s_suppkey AS partner_id, {CURRENCY_SQL.format('s_suppkey')} AS currency, account_type
FROM supplier, (VALUES ('settlement'), ('holding'), ('fee')) AS k(account_type)""")
def _provision(spark, sf_dir):
    countries = F.array(*[F.lit(c) for c in finance.CURRENCY_OF_COUNTRY])
    partners = b.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("partner_id"),
        F.get(countries, (F.col("s_suppkey") % 8).cast("int")).alias("country"),
    )
    return finance.provision_accounts(partners)


@query("initiated_events", with_tables("b_transactions", """
SELECT transaction_id, 'initiated' AS event_type,
  '{"method":"' || CASE transaction_id % 4 WHEN 0 THEN 'wire' WHEN 1 THEN 'card' WHEN 2 THEN 'pix' ELSE 'boleto' END
  || '","fx_rate":"1.00000000","source":"generator"}' AS metadata FROM b_transactions"""))
def _initiated(spark, sf_dir):
    methods = F.array(*[F.lit(m) for m in CONTRACTS["transactions"].domains["payment_method"]])
    transactions = b.transactions(spark, sf_dir).withColumns({
        "payment_method": F.get(methods, (F.col("transaction_id") % 4).cast("int")),
        "fx_rate": F.lit(1).cast("decimal(18,8)"),
    })
    return finance.initiated_events(transactions).drop("created_at")
