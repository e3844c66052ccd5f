"""Aircraft snapshots and observations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallylake.checks import fixtures as x
from tallylake.checks.registry import query
from tallylake.operators import aviation as v
from tallylake.session import new_run_folder
from tallylake.sources.bronze import list_bronze_objects
from tallylake.sources.snapshots import land_snapshots, scan_snapshots
from tallylake.streaming.observations import dedup_observation_stream

SPAN = x.SNAPSHOT_SPAN
SECONDS = "CAST(epoch_us(date_trunc('second', ts)) // 1000000 AS BIGINT)"
ICAO = "lpad(lower(to_hex(user_id)), 6, '0')"


def vector_sql(icao: str = ICAO, ground: str = "'false'", velocity: str = "CAST(value AS VARCHAR)") -> str:
    return (
        f"'[\"' || {icao} || '\",\"' || event_type || ' \",\"Brazil\",' || {SECONDS} || ',' || {SECONDS} "
        f"|| ',-46.625,-23.5,731.5,' || {ground} || ',' || {velocity} || ',268.5,-3.25,[' || user_id "
        "|| ',7],777.5,' || CASE WHEN event_type = 'signup' THEN '\"2217\"' ELSE 'null' END || ',false,0' || CASE WHEN event_type = 'click' THEN ',4' ELSE '' END || ']'"
    )


VECTORS = f"""vectors AS (SELECT event_id // {SPAN} AS block, event_id,
  ROW_NUMBER() OVER (PARTITION BY event_id // {SPAN} ORDER BY event_id) - 1 AS position,
  {vector_sql()} AS vector, event_type, value, user_id, {SECONDS} AS seconds,
  CASE WHEN event_id % 997 = 0 THEN 'invalid_icao24' WHEN event_id % 991 = 0 THEN 'invalid_on_ground'
       WHEN event_id % 983 = 0 THEN 'invalid_velocity' END AS fault FROM events)"""
BODY_ROWS = f"""SELECT block, COUNT(*) AS n, {x.FIRST_SECOND} + block * 60 AS time,
  '{{"time":' || ({x.FIRST_SECOND} + block * 60) || ',"states":[' || string_agg(vector, ',' ORDER BY event_id) || ']}}' AS body
  FROM vectors GROUP BY block"""
BODIES = f"{VECTORS}, bodies AS ({BODY_ROWS})"
KEY = "'aviation/opensky/snap-' || block || '.json'"
OBSERVED = "strftime(make_timestamp(seconds * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


@query("snapshot_catalog", f"""WITH {BODIES}, given AS (
SELECT block, time, n, body || CASE block % 5 WHEN 1 THEN ' garbage' WHEN 3 THEN body ELSE '' END AS body FROM bodies)
SELECT {KEY} AS object_key, CASE WHEN block % 5 NOT IN (1, 3) THEN CAST(time AS BIGINT) END AS source_time,
  CASE WHEN block % 5 NOT IN (1, 3) THEN n END AS state_count, CAST(strlen(body) AS BIGINT) AS size_bytes,
  sha256(body) AS sha256, CASE WHEN block % 5 IN (1, 3) THEN 'invalid_json' ELSE 'accepted' END AS verdict FROM given""")
def _catalog(spark, sf_dir):
    # Some bodies go on behind the object: with other text, or with the object once more.
    behind = F.when(F.col("block") % 5 == 1, F.encode(F.lit(" garbage"), "UTF-8")).when(F.col("block") % 5 == 3, F.col("content"))
    content = F.concat("content", F.coalesce(behind, F.encode(F.lit(""), "UTF-8")))
    found = v.snapshot_catalog(x.snapshots(spark, sf_dir).withColumn("content", content))
    verdict = F.coalesce("refusal", F.lit("accepted")).alias("verdict")
    return found.select(*[c for c in found.columns if c != "refusal"], verdict)


@query("scan_snapshots", f"""WITH {BODIES}
SELECT 'snap-' || block AS snapshot, CAST(strlen(body) + 1 AS BIGINT) AS stored_size,
  sha256(body || chr(10)) AS sha256, CASE WHEN block % 4 <> 3 THEN 'req-' || block END AS request_id FROM bodies""")
def _scan(spark, sf_dir):
    folder = x.snapshot_folder(spark, sf_dir)
    # File names are chosen by the writer, so the keys are taken from a listing; some objects have no metadata.
    listed = list_bronze_objects(spark, folder).where(F.col("key").endswith(".txt"))
    keys = listed.select(F.col("key").alias("object_key"))
    number = F.regexp_extract("object_key", r"snapshot_id=snap-(\d+)/", 1).cast("bigint")
    recorded = x.snapshots(spark, sf_dir).where("block % 4 <> 3").select("block", "metadata")
    metadata = keys.withColumn("block", number).join(recorded, "block").select("object_key", "metadata")
    found = scan_snapshots(spark, folder, metadata, "*.txt")
    return found.select(
        F.concat(F.lit("snap-"), number.cast("string")).alias("snapshot"), "stored_size", F.sha2("content", 256).alias("sha256"),
        v.metadata_value("request-id").alias("request_id"),
    )


@query("land_snapshots", f"""WITH {BODIES}
SELECT {KEY} AS object_key, sha256(body) AS sha256, n AS state_count,
  strftime(make_timestamp((time + 5) * 1000000), '%Y-%m-%d') AS dt,
  strftime(make_timestamp((time + 5) * 1000000), '%H') AS hour FROM bodies""")
def _land(spark, sf_dir):
    path = new_run_folder(spark, "landed-snapshots")
    land_snapshots(x.snapshots(spark, sf_dir), path)
    schema = "object_key STRING, content BINARY, metadata MAP<STRING, STRING>, dt STRING, hour STRING"
    landed = spark.read.schema(schema).parquet(path)
    count = v.metadata_value("state-count").cast("bigint")
    return landed.select("object_key", F.sha2("content", 256).alias("sha256"), count.alias("state_count"), "dt", "hour")


#: The fault that a snapshot is given, if any.
WRONG = "CASE block % {} {} END".format(len(x.WRONG) + 1, " ".join(f"WHEN {n} THEN '{fault}'" for n, fault in enumerate(x.WRONG, 1)))


@query("verify_snapshots", f"""WITH {BODIES}, judged AS (SELECT *, {WRONG} AS refusal FROM bodies)
SELECT {KEY} AS object_key, CASE WHEN refusal IS DISTINCT FROM 'missing_snapshot_id' THEN 'snap-' || block END AS snapshot_id,
  CASE WHEN COALESCE(refusal NOT LIKE '%collected_at%', TRUE) THEN strftime(make_timestamp((time + 5) * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS collected_at,
  CASE WHEN refusal = 'invalid_states' THEN 5 WHEN COALESCE(refusal NOT IN ('invalid_json', 'not_an_object', 'invalid_time'), TRUE)
       THEN CAST(time AS BIGINT) END AS source_time,
  CASE WHEN COALESCE(refusal NOT IN ('invalid_json', 'not_an_object', 'invalid_time', 'invalid_states'), TRUE) THEN n END AS state_count,
  refusal FROM judged""")
def _verify(spark, sf_dir):
    return v.verify_snapshots(x.snapshots(spark, sf_dir, wrong=True)).select(
        "object_key", "snapshot_id", "collected_at", "source_time", "state_count", "refusal"
    )


def _verified(spark, sf_dir, faulted: bool = False):
    return v.verify_snapshots(x.snapshots(spark, sf_dir, faulted=faulted))


@query("explode_states", f"""WITH {VECTORS}
SELECT {KEY} AS object_key, CAST(position AS BIGINT) AS position, event_type || ' ' AS callsign FROM vectors""")
def _explode(spark, sf_dir):
    rows = v.explode_states(_verified(spark, sf_dir))
    return rows.select(
        "object_key", F.col("position").cast("bigint").alias("position"),
        F.variant_get("vector", "$[1]", "string").alias("callsign"),
    )


@query("invalid_states", f"""WITH {VECTORS}
SELECT {KEY} AS object_key, CAST(position AS BIGINT) AS position, fault FROM vectors WHERE fault IS NOT NULL""")
def _invalid(spark, sf_dir):
    faults = v.invalid_states(_verified(spark, sf_dir, faulted=True))
    return faults.withColumn("position", F.col("position").cast("bigint"))


@query("state_events", f"""WITH {VECTORS}, given AS (SELECT block, sha256(body) AS source_checksum FROM ({BODY_ROWS}))
SELECT CAST(1 AS BIGINT) AS schema_version, sha256(vector) AS event_id, 'opensky' AS source, 'req-' || block AS request_id,
  'snap-' || block AS snapshot_id, CAST({x.FIRST_SECOND} + block * 60 AS BIGINT) AS source_time,
  strftime(make_timestamp(({x.FIRST_SECOND} + block * 60 + 5) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS ingested_at, 'bronze' AS source_bucket,
  {KEY} AS source_object_key, source_checksum, {ICAO} AS icao24, event_type AS callsign, 'Brazil' AS origin_country,
  {OBSERVED} AS observed_at, {OBSERVED} AS last_contact_at, CAST(-46.625 AS DOUBLE) AS longitude, CAST(-23.5 AS DOUBLE) AS latitude,
  CAST(731.5 AS DOUBLE) AS baro_altitude_m, FALSE AS on_ground, value AS velocity_m_s, CAST(268.5 AS DOUBLE) AS true_track_deg,
  CAST(-3.25 AS DOUBLE) AS vertical_rate_m_s, user_id || ',7' AS sensors, CAST(777.5 AS DOUBLE) AS geo_altitude_m,
  CASE WHEN event_type = 'signup' THEN '2217' END AS squawk, FALSE AS spi, CAST(0 AS BIGINT) AS position_source,
  CAST(CASE WHEN event_type = 'click' THEN 4 END AS BIGINT) AS category
FROM vectors JOIN given USING (block) WHERE block NOT IN (SELECT block FROM vectors WHERE fault IS NOT NULL)""")
def _state_events(spark, sf_dir):
    events = v.state_events(v.refuse_invalid(_verified(spark, sf_dir, faulted=True)))
    return events.withColumn("sensors", F.array_join(F.col("sensors").cast("array<string>"), ","))


@query("state_event_id", f"""
SELECT event_id // {SPAN} AS block, sha256({vector_sql()}) AS event_id FROM events""")
def _event_id(spark, sf_dir):
    rows = v.explode_states(_verified(spark, sf_dir))
    block = F.regexp_extract("object_key", r"snap-(\d+)", 1).cast("bigint")
    return rows.select(block.alias("block"), v.state_event_id(F.col("vector")).alias("event_id"))


def _twice(spark, sf_dir):
    """Every observation from two snapshots: as collected, and republished a day later."""
    events = v.state_events(_verified(spark, sf_dir))
    later = events.withColumns({
        "ingested_at": F.lit("2099-01-01T00:00:00Z"),
        "source_object_key": F.concat(F.lit("again/"), F.col("source_object_key")),
    })
    return events.unionByName(later)


@query("dedup_observations", f"""WITH {VECTORS}
SELECT sha256(vector) AS event_id, MIN({KEY}) AS source_object_key FROM vectors GROUP BY 1""")
def _dedup(spark, sf_dir):
    return v.dedup_observations(_twice(spark, sf_dir)).select("event_id", "source_object_key")


@query("stream_dedup_events", f"""WITH {VECTORS}
SELECT DISTINCT sha256(vector) AS event_id, {ICAO} AS icao24 FROM vectors""")
def _stream_dedup(spark, sf_dir):
    run = new_run_folder(spark, "observations")
    events = _twice(spark, sf_dir).select("event_id", "icao24", "source_time").withColumn(
        "ingested_time", F.timestamp_seconds("source_time")
    )
    events.write.parquet(f"{run}/published")
    stream = spark.readStream.schema(events.schema).parquet(f"{run}/published")
    query_ = (
        dedup_observation_stream(stream, delay="365 days")
        .writeStream.format("parquet")
        .option("path", f"{run}/kept")
        .option("checkpointLocation", f"{run}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return spark.read.parquet(f"{run}/kept").select("event_id", "icao24")


@query("publish_observations", f"""WITH {VECTORS}
SELECT {ICAO} AS key, sha256(vector) AS event_id, {OBSERVED} AS observed_at, event_type <> 'signup' AS has_null_squawk,
  CAST(28 AS BIGINT) AS fields FROM vectors""")
def _publish(spark, sf_dir):
    path = new_run_folder(spark, "published")
    v.publish_observations(_verified(spark, sf_dir), new_run_folder(spark, "judged"), fmt="parquet", path=path)
    value = F.try_parse_json("value")
    squawk = F.try_variant_get(value, "$.squawk", "variant")
    return spark.read.parquet(path).select(
        "key",
        F.try_variant_get(value, "$.event_id", "string").alias("event_id"),
        F.try_variant_get(value, "$.observed_at", "string").alias("observed_at"),
        F.is_variant_null(squawk).alias("has_null_squawk"),
        F.size(F.json_object_keys("value")).cast("bigint").alias("fields"),
    )
