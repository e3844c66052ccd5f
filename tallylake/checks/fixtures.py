"""Inputs on disk and in JSON form, derived by Spark from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.checks import bindings as b
from tallylake.contracts import CONTRACTS, DELETED
from tallylake.operators.finance import initiated_events
from tallylake.plans.pipeline import BatchResult, Lake, run_landed_microbatch, run_microbatch
from tallylake.session import COMPACT, new_run_folder, released_shuffles
from tallylake.streaming.landing import land_cdc_stream

EVENTS = CONTRACTS["payment_events"]

_made: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """Make a derived input once per application and source folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


# --- change events of one table, from `events` -----------------------------------------

def dashed(hex32: Column) -> Column:
    for place in (21, 17, 13, 9):
        hex32 = F.overlay(hex32, F.lit("-"), place, 0)
    return hex32


def uuid_of(prefix: str, number: str | Column) -> Column:
    value = F.col(number) if isinstance(number, str) else number
    return dashed(F.md5(F.concat(F.lit(prefix), value.cast("string"))))


def key_spelling(number: str, uuid: Column) -> Column:
    """The same UUID in upper case, without dashes, or canonical."""
    spelling = F.col(number) % 5
    undashed = F.replace(uuid, F.lit("-"), F.lit(""))
    return F.when(spelling == 1, F.upper(uuid)).when(spelling == 2, undashed).otherwise(uuid)


def iso_text(clock: Column) -> Column:
    text = F.replace(clock.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(text, F.lit("Z"))


def _envelope(op: Column, lsn: Column, key_name: str, key: Column, after: Column) -> Column:
    deleted = op == "d"
    return F.struct(
        op.alias("op"),
        F.struct(lsn.alias("lsn")).alias("source"),
        F.when(deleted, F.struct(key.alias(key_name))).alias("before"),
        F.when(~F.coalesce(deleted, F.lit(False)), after).alias("after"),
    )


def _json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def _wrapped_when(condition: Column, envelope: Column) -> Column:
    schema = F.struct(F.lit("struct").alias("type"))
    wrapped = _json(F.struct(schema.alias("schema"), envelope.alias("payload")))
    return F.when(condition, wrapped).otherwise(_json(envelope))


def event_lines(spark: SparkSession, sf_dir: str, faulted: bool = False) -> DataFrame:
    """``value``: one envelope per event, keyed by user, half of them wrapped; plus event_id, ts."""
    events = b.table(spark, sf_dir, "events")
    number, kind = F.col("event_id"), F.col("event_type")

    def lost(every: int, value: Column) -> Column:
        return F.when(number % every != 0, value) if faulted else value

    op = F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")
    created = iso_text(F.col("ts"))
    if faulted:
        op = F.when(number % 79 == 0, "x").otherwise(op)
        # No time, and texts that a cast alone would take for one.
        lax = F.get(F.array(*map(F.lit, ("not-a-time", "12:30", "2026", "2026-01"))), (number % 4).cast("int"))
        created = F.when(number % 73 == 0, lax).otherwise(created)
    key = lost(83, key_spelling("event_id", uuid_of("user:", "user_id")))
    after = F.struct(
        key.alias("event_id"),
        uuid_of("txn:", "event_id").alias("transaction_id"),
        "event_type",
        F.col("props").alias("metadata"),
        created.alias("created_at"),
    )
    envelope = _envelope(lost(97, op), lost(89, number), "event_id", key, after)
    value = _wrapped_when(number % 2 == 0, envelope)
    if faulted:
        # A line that breaks off, and lines with more than one value.
        broken = F.array(
            F.lit('{"op":'), F.concat(value, value), F.concat(value, F.lit(" x}")), F.concat(value, F.lit(","), value)
        )
        value = F.when(number % 71 == 0, F.get(broken, (number % 4).cast("int"))).otherwise(value)
    return events.select(value.alias("value"), "event_id", "ts")


def event_folder(spark: SparkSession, sf_dir: str, faulted: bool = False) -> str:
    """The event lines landed below ``year=/month=/day=``."""
    def make() -> str:
        path = new_run_folder(spark, "bronze") + "/topics/cdc.public.payment_events"
        (
            event_lines(spark, sf_dir, faulted)
            .select(
                "value",
                F.year("ts").alias("year"),
                F.lpad(F.month("ts").cast("string"), 2, "0").alias("month"),
                F.lpad(F.day("ts").cast("string"), 2, "0").alias("day"),
            )
            .hint("rebalance", F.col("year"), F.col("month"), F.col("day"))
            .write.partitionBy("year", "month", "day")
            .text(path)
        )
        return path

    return once(spark, sf_dir, f"event_folder:{faulted}", make)


# --- change events of all five tables, and the lake they give --------------------------

#: Second-batch versions start above every first-batch LSN.
SECOND_LSN = 10_000_000_000


def _created(number: str) -> Column:
    """Four weeks of creation times, so that day partitions hold many rows each."""
    step = F.make_dt_interval(F.col(number) % 28, F.lit(0), F.lit(0), F.col(number) % 86400)
    return F.lit("2024-01-01").cast("timestamp_ntz") + step


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions on plain numbers, written once: three tables of both batches are made of them."""
    rows = b.transactions(spark, sf_dir)

    def make() -> str:
        path = new_run_folder(spark, "transactions")
        with released_shuffles(spark):
            # Small rows, dealt evenly: lines are made by as many tasks, and a compressed object is read by one.
            rows.repartition(spark.sparkContext.defaultParallelism).write.options(**COMPACT).parquet(path)
        return path

    return spark.read.schema(rows.schema).parquet(once(spark, sf_dir, "transactions", make))


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables with UUID keys, a row number ``n`` and the flag of rows deleted later."""
    partners = b.partners(spark, sf_dir).select(
        F.col("partner_id").alias("n"), uuid_of("partner:", "partner_id").alias("partner_id"),
        "name", "country", "partner_type", "status", DELETED,
    )
    accounts = b.accounts(spark, sf_dir).select(
        F.col("account_id").alias("n"), uuid_of("account:", "account_id").alias("account_id"),
        uuid_of("partner:", "partner_id").alias("partner_id"),
        "currency", "account_type", "status", DELETED,
    )
    plain = _transactions(spark, sf_dir)
    rows = plain.withColumn("created_at", _created("transaction_id"))
    methods = F.array(*[F.lit(m) for m in CONTRACTS["transactions"].domains["payment_method"]])
    transactions = rows.select(
        F.col("transaction_id").alias("n"),
        uuid_of("txn:", "transaction_id").alias("transaction_id"),
        uuid_of("account:", "source_account_id").alias("source_account_id"),
        uuid_of("account:", "destination_account_id").alias("destination_account_id"),
        "amount", "currency",
        F.lit("1.00000000").cast("decimal(18,8)").alias("fx_rate"),
        F.col("amount").alias("converted_amount"),
        F.col("currency").alias("converted_currency"),
        F.get(methods, (F.col("transaction_id") % 4).cast("int")).alias("payment_method"),
        "status",
        F.concat(F.lit("Transfer in "), F.col("currency")).alias("description"),
        "created_at", DELETED,
    )
    payment_events = initiated_events(transactions, carry=("n", DELETED)).withColumn(
        "event_id", uuid_of("event:", "n")
    )
    entries = b.ledger_entries(spark, sf_dir, plain).withColumn("created_at", _created("transaction_id"))
    ledger = entries.select(
        F.col("entry_id").alias("n"), uuid_of("entry:", "entry_id").alias("entry_id"),
        uuid_of("txn:", "transaction_id").alias("transaction_id"),
        uuid_of("account:", "account_id").alias("account_id"),
        "entry_type", "amount", "currency",
        F.col("entry_type").alias("description"), "created_at", DELETED,
    )
    return {
        "partners": partners, "accounts": accounts, "transactions": transactions,
        "payment_events": payment_events, "ledger_entries": ledger,
    }


def _lines(df: DataFrame, name: str, op: Column, lsn: Column) -> DataFrame:
    """Change lines of a table: amounts and times as text, as the connector sends them."""
    contract = CONTRACTS[name]
    fields = []
    for column in contract.business_fields:
        if column.name not in df.columns:
            fields.append(F.lit("2024-01-01T00:00:00Z").alias(column.name))
        elif column.name == "created_at":
            fields.append(iso_text(F.col("created_at")).alias("created_at"))
        else:
            fields.append(F.col(column.name).cast("string").alias(column.name))
    key = F.col(contract.primary_key)
    envelope = _envelope(op, lsn, contract.primary_key, key, F.struct(*fields))
    return df.select(_wrapped_when(F.col("n") % 2 == 0, envelope).alias("value"), "n")


def first_batch(df: DataFrame, name: str) -> DataFrame:
    """Every row as first read; transactions start pending."""
    if name == "transactions":
        df = df.withColumn("status", F.lit("pending"))
    return _lines(df, name, F.lit("r"), F.col("n") + 1)


def final_versions(df: DataFrame, name: str) -> DataFrame:
    """Final values and deletes."""
    return _lines(df, name, F.when(F.col(DELETED), "d").otherwise("u"), F.col("n") + 1 + SECOND_LSN)


def second_batch(df: DataFrame, name: str) -> DataFrame:
    """Final versions, and a stale repeat of every first version of a deleted row."""
    return final_versions(df, name).unionByName(first_batch(df.where(DELETED), name))


#: A compressed object isn't split, so its size is bounded.
OBJECT_LINES = 1_000_000


def _land(spark: SparkSession, lines: DataFrame, root: str, table: str, offset: int) -> None:
    """Write lines as compressed broker-style objects: part ``i`` is broker partition ``i``."""
    topic = f"cdc.public.{table}"
    folder = f"{root}/topics/{topic}/year=2024/month=02/day=01"
    written = new_run_folder(spark, "landing")
    lines.select("value").write.options(compression="gzip", maxRecordsPerFile=OBJECT_LINES).text(written)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    source, target = path(written), path(folder)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    parts = sorted(
        status.getPath().getName()
        for status in fs.listStatus(source)
        if status.getPath().getName().startswith("part-")
    )
    for number, part in enumerate(parts):
        fs.rename(path(source, part), path(target, f"{topic}+{number}+{offset:010d}.json.gz"))


class FinishedLake:
    """A lake after two micro-batches, with what each of them did."""

    def __init__(self, lake: Lake, bronze: str, results: list[BatchResult]):
        self.lake, self.bronze, self.results = lake, bronze, results


def _only_current(lake: Lake) -> None:
    """Nobody reads the states of before the second batch."""
    for name in lake.contracts:
        lake.silver(name).vacuum(keep=1)


def finished_lake(spark: SparkSession, sf_dir: str) -> FinishedLake:
    def make() -> FinishedLake:
        bronze, lake = new_run_folder(spark, "bronze"), Lake(spark, new_run_folder(spark, "lake"))
        tables, results = source_tables(spark, sf_dir), []
        for offset, batch in ((0, first_batch), (1_000_000, second_batch)):
            for name, df in tables.items():
                _land(spark, batch(df, name), bronze, name, offset)
            results.append(run_microbatch(spark, bronze, lake))
        _only_current(lake)
        return FinishedLake(lake, bronze, results)

    done = once(spark, sf_dir, "finished_lake", make)
    return FinishedLake(Lake(spark, done.lake.root), done.bronze, done.results)


#: Offsets of the first read, of final versions and of stale repeats lie this far apart.
OFFSET_STEP = 1_000_000_000_000


def change_messages(df: DataFrame, name: str, second: bool) -> DataFrame:
    """The lines of a batch as broker messages: three partitions, a day each, offsets by row number."""
    def messages(lines: DataFrame, step: int) -> DataFrame:
        partition = F.col("n") % 3
        return lines.select(
            F.lit(f"cdc.public.{name}").alias("topic"), partition.cast("int").alias("partition"),
            (F.lit(step * OFFSET_STEP) + F.col("n")).alias("offset"),
            F.timestamp_seconds(F.lit(1_706_800_000) + partition * 86400).alias("timestamp"), "value",
        )

    if not second:
        return messages(first_batch(df, name), 0)
    return messages(final_versions(df, name), 1).unionByName(messages(first_batch(df.where(DELETED), name), 2))


def landed_lake(spark: SparkSession, sf_dir: str) -> FinishedLake:
    """A lake from the same changes as ``finished_lake``, by way of messages that a stream lands as Parquet."""
    def make() -> FinishedLake:
        run, lake = new_run_folder(spark, "landed"), Lake(spark, new_run_folder(spark, "lake"))
        tables, results = source_tables(spark, sf_dir), []
        for number in (0, 1):
            for name, df in tables.items():
                messages = change_messages(df, name, bool(number))
                messages.write.mode("append").options(**COMPACT).parquet(f"{run}/messages/batch={number}")
            schema = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING, batch INT"
            stream = spark.readStream.schema(schema).parquet(f"{run}/messages").drop("batch")
            land_cdc_stream(stream, f"{run}/landing", f"{run}/checkpoint", fmt="parquet", availableNow=True).awaitTermination()
            # The stream has landed these; the broker keeps them no longer.
            fs, sent = lake.checkpoint._file_system(f"{run}/messages/batch={number}")
            fs.delete(sent, True)
            results.append(run_landed_microbatch(spark, f"{run}/landing", lake))
        _only_current(lake)
        return FinishedLake(lake, f"{run}/landing", results)

    done = once(spark, sf_dir, "landed_lake", make)
    return FinishedLake(Lake(spark, done.lake.root), done.bronze, done.results)


# --- aircraft snapshots ----------------------------------------------------------------

#: Events per snapshot: event ids are unique, so a snapshot never holds more vectors.
SNAPSHOT_SPAN = 250
FIRST_SECOND = 1704067200


def state_vectors(spark: SparkSession, sf_dir: str, faulted: bool = False) -> DataFrame:
    """(block, event_id, vector): one state vector as JSON text per event."""
    number = F.col("event_id")
    icao24 = F.lpad(F.lower(F.hex("user_id")), 6, "0")
    on_ground, velocity = F.lit("false"), F.col("value").cast("string")
    if faulted:
        icao24 = F.when(number % 997 == 0, "xyz").otherwise(icao24)
        on_ground = F.when(number % 991 == 0, "0").otherwise(on_ground)
        velocity = F.when(
            number % 983 == 0, F.concat(F.lit('"'), velocity, F.lit('"'))
        ).otherwise(velocity)
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    squawk = F.when(F.col("event_type") == "signup", '"2217"').otherwise("null")
    category = F.when(F.col("event_type") == "click", ",4").otherwise("")
    vector = F.concat(
        F.lit('["'), icao24, F.lit('","'), F.col("event_type"), F.lit(' ","Brazil",'),
        seconds, F.lit(","), seconds, F.lit(",-46.625,-23.5,731.5,"), on_ground, F.lit(","), velocity,
        F.lit(",268.5,-3.25,["), F.col("user_id").cast("string"), F.lit(",7],777.5,"), squawk, F.lit(",false,0"),
        category, F.lit("]"),
    )
    return b.table(spark, sf_dir, "events").select(
        F.floor(number / SNAPSHOT_SPAN).alias("block"), "event_id", vector.alias("vector")
    )


#: What ``wrong`` snapshots are refused for: block ``i`` by entry ``i % 17 - 1``, or for nothing.
WRONG = (
    "missing_sha256", "checksum_differs", "size_differs", "missing_source_time", "time_differs", "missing_state_count",
    "count_differs", "missing_collected_at", "invalid_collected_at", "collected_at_without_offset", "missing_snapshot_id",
    "missing_request_id", "invalid_json", "not_an_object", "invalid_time", "invalid_states",
)


def snapshots(
    spark: SparkSession, sf_dir: str, faulted: bool = False, wrong: bool = False
) -> DataFrame:
    """object_key, content, stored_size, metadata and collected_at of each snapshot."""
    vectors = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("event_id", "vector"))),
                    lambda v: v["vector"]), ","
    )
    block = F.col("block")
    time = F.lit(FIRST_SECOND) + block * 60
    bodies = (
        state_vectors(spark, sf_dir, faulted)
        .groupBy("block")
        .agg(F.count(F.lit(1)).alias("n"), vectors.alias("vectors"))
        .select(
            "block", "n", time.alias("time"),
            F.concat(F.lit('{"time":'), time.cast("string"), F.lit(',"states":['),
                     F.col("vectors"), F.lit("]}")).alias("body"),
        )
    )
    def when(refusal: str, value: Column, usual: Column) -> Column:
        return F.when(block % (len(WRONG) + 1) == WRONG.index(refusal) + 1, value).otherwise(usual) if wrong else usual

    body, nothing = F.col("body"), F.lit("")
    body = when("invalid_json", F.concat(F.col("body"), F.lit(" x")), body)
    body = when("not_an_object", F.concat(F.lit("["), F.col("body"), F.lit("]")), body)
    body = when("invalid_time", F.lit('{"time":"5","states":[]}'), body)
    bodies = bodies.withColumn("body", when("invalid_states", F.lit('{"time":5,"states":{}}'), body))
    collected = F.timestamp_seconds(F.col("time") + 5)
    text = F.date_format(collected, "yyyy-MM-dd'T'HH:mm:ss")
    when_collected = when("collected_at_without_offset", text, F.concat(text, F.lit("+00:00")))
    when_collected = when("invalid_collected_at", F.lit("yesterday"), when("missing_collected_at", nothing, when_collected))
    recorded, count = F.col("time").cast("string"), F.col("n").cast("string")
    recorded = when("missing_source_time", nothing, when("time_differs", (F.col("time") + 1).cast("string"), recorded))
    count = when("missing_state_count", nothing, when("count_differs", (F.col("n") + 1).cast("string"), count))
    checksum = when("missing_sha256", nothing, when("checksum_differs", F.lit("wrong"), F.sha2("body", 256)))
    number = block.cast("string")
    metadata = F.create_map(
        F.lit("X-Amz-Meta-snapshot-id"), when("missing_snapshot_id", nothing, F.concat(F.lit("snap-"), number)),
        F.lit("X-Amz-Meta-request-id"), when("missing_request_id", nothing, F.concat(F.lit("req-"), number)),
        F.lit("Collected-At"), when_collected,
        F.lit("x-amz-meta-source-time"), recorded,
        F.lit("X-Amz-Meta-State-Count"), count,
        F.lit("X-Amz-Meta-sha256"), checksum,
    )
    size = F.octet_length("body").cast("bigint")
    return bodies.select(
        F.concat(F.lit("aviation/opensky/snap-"), block.cast("string"), F.lit(".json")).alias(
            "object_key"
        ),
        F.encode("body", "UTF-8").alias("content"),
        when("size_differs", size + 1, size).alias("stored_size"),
        metadata.alias("metadata"),
        collected.alias("collected_at"),
        "block",
    )


def snapshot_folder(spark: SparkSession, sf_dir: str) -> str:
    """The snapshots as one file each, below ``dt=/hour=/snapshot_id=``."""
    def make() -> str:
        path = new_run_folder(spark, "snapshots")
        (
            snapshots(spark, sf_dir)
            .select(
                F.decode("content", "UTF-8").alias("value"),
                F.date_format("collected_at", "yyyy-MM-dd").alias("dt"),
                F.date_format("collected_at", "HH").alias("hour"),
                F.concat(F.lit("snap-"), F.col("block").cast("string")).alias("snapshot_id"),
            )
            .write.partitionBy("dt", "hour", "snapshot_id")
            .text(path)
        )
        return path

    return once(spark, sf_dir, "snapshot_folder", make)


# --- object keys -----------------------------------------------------------------------

def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed object key per order: topic by status; some keys are malformed."""
    number, status = F.col("o_orderkey"), F.col("o_orderstatus")
    topic = F.concat(
        F.lit("cdc.public."),
        F.when(status == "F", "transactions").when(status == "O", "accounts").otherwise("unknown"),
    )
    name_topic = F.when(number % 13 == 0, F.lit("cdc.public.other")).otherwise(topic)
    prefix = F.when(number % 17 == 0, F.lit("archive/")).otherwise(F.lit("topics/"))
    ending = F.when(number % 19 == 0, F.lit(".json.tmp")).otherwise(F.lit(".json"))
    key = F.concat(
        prefix, topic, F.lit("/"), F.date_format("o_orderdate", "'year='yyyy'/month='MM'/day='dd"),
        F.lit("/"), name_topic, F.lit("+"), (number % 3).cast("string"), F.lit("+"),
        F.lpad(number.cast("string"), 10, "0"), ending,
    )
    def make() -> str:
        path = new_run_folder(spark, "object-keys")
        b.table(spark, sf_dir, "orders").select(key.alias("key")).write.parquet(path)
        return path

    return spark.read.schema("key STRING").parquet(once(spark, sf_dir, "object_keys", make))


def half_checkpoints(objects: DataFrame) -> DataFrame:
    """A checkpoint half way through each topic, missing for broker partition 2."""
    return (
        objects.where("partition <> 2")
        .groupBy("topic", "partition")
        .agg(F.floor(F.max("start_offset") / 2).alias("last_offset"))
    )
