"""Change events: reading, envelope, validation, latest version, guarded upsert, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.checks import bindings as b
from tallylake.checks import fixtures as x
from tallylake.checks.registry import dashed_md5, query
from tallylake.contracts import DELETED, LSN
from tallylake.functions.keys import canonical_uuid, canonical_uuid_bytes
from tallylake.operators import envelope as e
from tallylake.operators.latest import accepted_versions, at_or_below, latest_by_lsn
from tallylake.operators.reconcile import batch_state_failures, failure_sample
from tallylake.session import COMPACT, new_run_folder, released_shuffles
from tallylake.sources import bronze
from tallylake.sources.tables import SilverTable
from tallylake.streaming.cdc import apply_cdc_stream
from tallylake.streaming.landing import land_cdc_stream

EVENTS = x.EVENTS
USER_KEY = dashed_md5("'user:' || user_id")
TXN_KEY = dashed_md5("'txn:' || event_id")

#: Contract columns as SQL over `events`; a delete carries its key only.
ROWS = f"""SELECT {USER_KEY} AS event_id,
  CASE WHEN event_type <> 'error' THEN {TXN_KEY} END AS transaction_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
  CASE WHEN event_type <> 'error' THEN props END AS metadata,
  CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS created_us,
  event_id AS _cdc_lsn, event_type = 'error' AS _cdc_deleted, user_id FROM events"""
SHOWN = "event_id, transaction_id, event_type, metadata, created_us, _cdc_lsn, _cdc_deleted"
LATEST = f"""SELECT {SHOWN} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY _cdc_lsn DESC) AS n
FROM ({ROWS})) WHERE n = 1"""


def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("created_us", F.unix_micros("created_at")).select(
        "event_id", "transaction_id", "event_type", "metadata", "created_us", LSN, DELETED
    )


def lines(spark, sf_dir: str, faulted: bool = False) -> DataFrame:
    return bronze.scan_bronze_paths(spark, x.event_folder(spark, sf_dir, faulted))


def normalised(spark, sf_dir: str, faulted: bool = False) -> DataFrame:
    return e.normalise_events(lines(spark, sf_dir, faulted), EVENTS)


def typed(spark, sf_dir: str) -> DataFrame:
    return normalised(spark, sf_dir).select(EVENTS.columns)


def silver(spark) -> SilverTable:
    return SilverTable(spark, new_run_folder(spark, "silver"), EVENTS)


# --- reading ---------------------------------------------------------------------------

@query("scan_cdc_json", """
SELECT event_id AS lsn, event_id % 2 = 0 AS wrapped FROM events""")
def _scan(spark, sf_dir):
    # Blank lines are put between the events; they are no rows.
    path = new_run_folder(spark, "ndjson")
    spaced = x.event_lines(spark, sf_dir).select(F.concat("value", F.lit("\n   ")).alias("value"))
    spaced.write.text(path)
    parsed = F.try_parse_json("value")
    return bronze.scan_cdc_json(spark, path).select(
        F.coalesce(
            F.try_variant_get(parsed, "$.source.lsn", "bigint"),
            F.try_variant_get(parsed, "$.payload.source.lsn", "bigint"),
        ).alias("lsn"),
        F.try_variant_get(parsed, "$.payload", "variant").isNotNull().alias("wrapped"),
    )


@query("scan_bronze_paths", """
SELECT event_id AS lsn, CAST(ts AS DATE) = DATE '2024-01-15' AS in_day FROM events""")
def _scan_paths(spark, sf_dir):
    folder = x.event_folder(spark, sf_dir)

    def lsns(found: DataFrame) -> DataFrame:
        return e.normalise_events(found, EVENTS).select(F.col(LSN).alias("lsn"))

    one_day = lsns(bronze.scan_bronze_paths(spark, folder, date="2024-01-15"))
    found = lsns(bronze.scan_bronze_paths(spark, folder)).join(
        one_day.withColumn("in_day", F.lit(True)), "lsn", "left"
    )
    return found.withColumn("in_day", F.coalesce("in_day", F.lit(False)))


# --- envelope --------------------------------------------------------------------------

@query("extract_envelope", f"""
SELECT CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
  CAST(event_id AS VARCHAR) AS lsn, CASE WHEN event_type <> 'error' THEN props END AS metadata,
  CASE WHEN event_type = 'error' THEN {USER_KEY} END AS before_key FROM events""")
def _envelope(spark, sf_dir):
    df = e.extract_envelope(lines(spark, sf_dir), EVENTS)
    before = canonical_uuid(F.col("before_key"))
    return df.select("op", "lsn", F.col("after.metadata"), before.alias("before_key"))


@query("project_contract", f"SELECT {SHOWN} FROM ({ROWS})")
def _project(spark, sf_dir):
    checked = e.validate_cdc_batch(normalised(spark, sf_dir), EVENTS)
    return shown(checked)


@query("recover_delete_key", f"""
SELECT {USER_KEY} AS event_id, event_id AS lsn, event_type = 'error' AS deleted FROM events""")
def _recover(spark, sf_dir):
    df = e.extract_envelope(lines(spark, sf_dir), EVENTS)
    key = canonical_uuid(e.recover_delete_key(df, EVENTS))
    change = e.cdc_columns(df)
    return df.select(
        key.alias("event_id"), change[LSN].alias("lsn"), change[DELETED].alias("deleted")
    )


@query("cdc_columns", """
SELECT event_id AS _cdc_lsn, event_type = 'error' AS _cdc_deleted FROM events""")
def _cdc_columns(spark, sf_dir):
    df = e.extract_envelope(lines(spark, sf_dir), EVENTS)
    return df.select(*[column.alias(name) for name, column in e.cdc_columns(df).items()])


@query("cutoff_filter", f"""
SELECT {SHOWN} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY _cdc_lsn DESC) AS n
FROM ({ROWS}) WHERE _cdc_lsn <= (SELECT MAX(event_id) // 2 FROM events)) WHERE n = 1""")
def _cutoff(spark, sf_dir):
    half = b.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2
    return shown(latest_by_lsn(at_or_below(typed(spark, sf_dir), half), EVENTS.primary_key))


BROKEN = """WITH broken AS (
SELECT event_id % 71 = 0 AS malformed, event_id % 97 = 0 AS no_op, event_id % 89 = 0 AS no_lsn,
  event_id % 83 = 0 AS no_key, event_id % 79 = 0 AS other_op, event_id % 73 = 0 AS bad_time,
  event_type = 'error' AND event_id % 79 <> 0 AND event_id % 97 <> 0 AS deleted FROM events)"""
COUNTS = """COUNT(*) FILTER (WHERE malformed) AS malformed_json,
  COUNT(*) FILTER (WHERE NOT malformed AND no_op) AS missing_op,
  COUNT(*) FILTER (WHERE NOT malformed AND no_lsn) AS missing_lsn,
  COUNT(*) FILTER (WHERE NOT malformed AND no_key) AS missing_primary_key,
  COUNT(*) FILTER (WHERE NOT malformed AND NOT no_op AND other_op) AS unsupported_op,
  COUNT(*) FILTER (WHERE NOT malformed AND NOT deleted AND bad_time) AS invalid_values"""


@query("contract_counts", f"{BROKEN} SELECT {COUNTS} FROM broken")
def _counts(spark, sf_dir):
    return e.contract_counts(normalised(spark, sf_dir, faulted=True))


@query("validate_cdc_batch", f"""{BROKEN}, counted AS (SELECT {COUNTS} FROM broken)
SELECT rule, failures FROM counted UNPIVOT (failures FOR rule IN (malformed_json, missing_op,
  missing_lsn, missing_primary_key, unsupported_op, invalid_values)) WHERE failures > 0""")
def _validate(spark, sf_dir):
    counts = e.contract_counts(normalised(spark, sf_dir, faulted=True))
    return counts.unpivot([], counts.columns, "rule", "failures").where("failures > 0")


@query("canonical_key", f"SELECT event_id, {USER_KEY} AS from_text, {USER_KEY} AS from_bytes FROM events")
def _canonical_key(spark, sf_dir):
    uuid = x.uuid_of("user:", "user_id")
    raw = F.unhex(F.md5(F.concat(F.lit("user:"), F.col("user_id").cast("string"))))
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        canonical_uuid(x.key_spelling("event_id", uuid)).alias("from_text"),
        canonical_uuid_bytes(raw).alias("from_bytes"),
    )


@query("align_to_contract", f"SELECT {SHOWN} FROM ({ROWS})")
def _align(spark, sf_dir):
    rows = typed(spark, sf_dir)
    # Another order and a narrower LSN; the contract restores both.
    shuffled = rows.select(
        DELETED, F.col(LSN).cast("int").alias(LSN),
        *[c for c in reversed(EVENTS.columns) if c not in (LSN, DELETED)],
    )
    return shown(e.align_to_contract(shuffled, EVENTS))


# --- latest version and upsert ---------------------------------------------------------

@query("latest_by_lsn", LATEST)
def _latest(spark, sf_dir):
    return shown(latest_by_lsn(typed(spark, sf_dir), EVENTS.primary_key))


def _user_versions(spark, sf_dir: str) -> DataFrame:
    """Latest event of each user, on plain numbers."""
    events = b.payment_events(spark, sf_dir).select(
        F.col("transaction_id").alias("user_id"), LSN, DELETED
    )
    return latest_by_lsn(events, "user_id")


USERS = """users AS (SELECT user_id, MAX(event_id) AS lsn,
  arg_max(event_type = 'error', event_id) AS deleted FROM events GROUP BY user_id)"""


@query("accepted_versions", f"""WITH {USERS}
SELECT user_id, lsn AS _cdc_lsn, user_id % 3 <> 1 AS accepted FROM users""")
def _accepted(spark, sf_dir):
    batch = _user_versions(spark, sf_dir)
    unknown, same = F.col("user_id") % 3 == 0, F.col("user_id") % 3 == 1
    stored = batch.where(~unknown).withColumn(LSN, F.when(same, F.col(LSN)).otherwise(F.col(LSN) - 1))
    return accepted_versions(batch, stored, "user_id").select("user_id", LSN, "accepted")


def _kept(spark, df: DataFrame, name: str) -> DataFrame:
    """The same rows, written: an upsert reads its batch several times."""
    path = new_run_folder(spark, name)
    df.write.options(**COMPACT).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _typed_once(spark, sf_dir: str) -> DataFrame:
    return _kept(spark, typed(spark, sf_dir), "typed")


def _thirds(spark, rows: DataFrame) -> list[DataFrame]:
    third = F.pmod(F.xxhash64(LSN), F.lit(3))
    parts = [latest_by_lsn(rows.where(third == n), EVENTS.primary_key) for n in range(3)]
    return [_kept(spark, part, "third") for part in parts]


@query("upsert_latest_state", LATEST)
def _upsert(spark, sf_dir):
    # Any split of the events in any order gives the state of all of them.
    table = silver(spark)
    with released_shuffles(spark):
        first, second, third = _thirds(spark, _typed_once(spark, sf_dir))
        for part in (second, third, first):
            table.apply(part)
    return shown(table.read())


@query("replay_idempotent", f"""
SELECT {SHOWN}, CAST(0 AS BIGINT) AS applied_again FROM ({LATEST})""")
def _replay(spark, sf_dir):
    table = silver(spark)
    with released_shuffles(spark):
        rows = _typed_once(spark, sf_dir)
        everything = _kept(spark, latest_by_lsn(rows, EVENTS.primary_key), "latest")
        table.apply(everything)
        again = sum(table.apply(part)[0] for part in (everything, *_thirds(spark, rows)))
        table.compact(force=True)
    return shown(table.read()).withColumn("applied_again", F.lit(again).cast("bigint"))


FAULTED_STATE = f"""{USERS}, stored AS (
SELECT user_id, CASE WHEN user_id % 11 = 0 THEN lsn - 1 WHEN user_id % 17 = 0 THEN lsn + 1 ELSE lsn END AS lsn,
  CASE WHEN user_id % 13 = 0 THEN NOT deleted ELSE deleted END AS deleted FROM users WHERE user_id % 7 <> 0),
failures AS (SELECT u.user_id AS key,
  CASE WHEN s.user_id IS NULL THEN 'absent' WHEN s.lsn < u.lsn THEN 'older_lsn'
       WHEN s.lsn = u.lsn AND s.deleted <> u.deleted THEN 'tombstone_differs' END AS reason,
  u.lsn AS lsn, s.lsn AS stored_lsn FROM users u LEFT JOIN stored s ON u.user_id = s.user_id)"""


def _state_failures(spark, sf_dir) -> DataFrame:
    batch, user, lsn = _user_versions(spark, sf_dir), F.col("user_id"), F.col(LSN)
    stored = batch.where(user % 7 != 0).withColumns({
        LSN: F.when(user % 11 == 0, lsn - 1).when(user % 17 == 0, lsn + 1).otherwise(lsn),
        DELETED: F.when(user % 13 == 0, ~F.col(DELETED)).otherwise(F.col(DELETED)),
    })
    return batch_state_failures(batch, stored, "user_id")


@query("batch_state_failures", f"WITH {FAULTED_STATE} SELECT * FROM failures WHERE reason IS NOT NULL")
def _batch_failures(spark, sf_dir):
    return _state_failures(spark, sf_dir)


@query("failure_sample", f"""WITH {FAULTED_STATE}
SELECT * FROM failures WHERE reason IS NOT NULL ORDER BY key, reason LIMIT 10""")
def _failure_sample(spark, sf_dir):
    return failure_sample(_state_failures(spark, sf_dir))


# --- streams ---------------------------------------------------------------------------

@query("stream_cdc_upsert", LATEST)
def _stream_upsert(spark, sf_dir):
    table, run = silver(spark), new_run_folder(spark, "stream")
    source = (
        spark.readStream.schema("value STRING, year INT, month INT, day INT")
        .option("maxFilesPerTrigger", 12)
        .text(x.event_folder(spark, sf_dir))
        .select("value")
    )
    stream = apply_cdc_stream(source, table, f"{run}/checkpoint", f"{run}/staged", availableNow=True)
    stream.awaitTermination()
    return shown(table.read())


@query("land_cdc_stream", f"""
SELECT 'cdc.public.payment_events' AS topic, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS landed_day,
  event_id AS lsn, {USER_KEY} AS event_id, CASE WHEN event_type <> 'error' THEN props END AS metadata,
  CASE WHEN event_type = 'error' THEN 'd' WHEN event_type = 'signup' THEN 'c' ELSE 'u' END AS op FROM events""")
def _land(spark, sf_dir):
    run = new_run_folder(spark, "landing")
    messages = x.event_lines(spark, sf_dir).select(
        F.lit("cdc.public.payment_events").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "value",
    )
    messages.write.parquet(f"{run}/messages")
    stream = spark.readStream.schema(messages.schema).parquet(f"{run}/messages")
    landing = land_cdc_stream(stream, f"{run}/landed", f"{run}/checkpoint", availableNow=True)
    landing.awaitTermination()
    schema = "value STRING, topic STRING, year STRING, month STRING, day STRING"
    landed = spark.read.schema(schema).text(f"{run}/landed")
    # The landed text as the library reads it, so each value of an event counts.
    envelope = e.extract_envelope_with(landed, EVENTS, ["topic", "year", "month", "day"])
    key = canonical_uuid(e.recover_delete_key(envelope, EVENTS))
    return envelope.select(
        "topic", F.concat_ws("-", "year", "month", "day").alias("landed_day"), F.col("lsn").cast("bigint").alias("lsn"),
        key.alias("event_id"), F.col("after.metadata").alias("metadata"), "op",
    )
