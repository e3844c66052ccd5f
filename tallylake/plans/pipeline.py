"""One micro-batch from landed files, or from landed messages, to published Gold tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.contracts import CONTRACTS, LSN, TableContract
from tallylake.operators import manifest as m
from tallylake.operators.envelope import stage_events
from tallylake.operators.latest import at_or_below, latest_of_written
from tallylake.operators.reconcile import reconcile_batch
from tallylake.plans.gold import build_gold
from tallylake.plans.gold_tests import gold_quality_report, observed, passed_tests
from tallylake.plans.staging import staging_models
from tallylake.session import COMPACT, released_shuffles
from tallylake.sources.bronze import (
    drop_blank, inside_ranges, list_bronze_objects, open_day_folders, scan_landed_messages, scan_new_files,
)
from tallylake.sources.tables import SilverTable, VersionedTable

CHECKPOINT_SCHEMA = m.CHECKPOINT_SCHEMA + ", last_day DATE, lsn BIGINT"
#: A broker partition's next file lies at most so many days before its newest one.
LATENESS_DAYS = 7
#: (topic, partition, after, up to): what one broker partition has that is new.
Range = tuple[str, int, int, int]


class GateError(RuntimeError):
    """A check failed. Gold keeps its last version and the checkpoint stays."""


@dataclass
class BatchResult:
    """What one run did. ``applied`` maps a table to (applied, ignored)."""

    committed: bool
    cutoff_lsn: int | None = None
    applied: dict[str, tuple[int, int]] = field(default_factory=dict)


class GoldTable(VersionedTable):
    """A Gold model. Its states are written here; which one is current, the lake's release says."""

    def __init__(self, lake: Lake, model: str):
        super().__init__(lake.spark, f"{lake.root}/gold/{model}")
        self.lake, self.model = lake, model

    def read(self) -> DataFrame:
        row = self.lake.releases.read().where(F.col("model") == self.model).first()
        if row is None:
            raise FileNotFoundError(f"No released state of {self.model}.")
        return self.spark.read.parquet(f"{self.path}/{row.folder}")


class Lake:
    """The folders of one lake: current-state tables, Gold tables and the checkpoint."""

    def __init__(self, spark: SparkSession, root: str, contracts=None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.contracts: dict[str, TableContract] = contracts or CONTRACTS

    def silver(self, table: str) -> SilverTable:
        return SilverTable(self.spark, f"{self.root}/silver/{table}", self.contracts[table])

    def gold(self, model: str) -> GoldTable:
        return GoldTable(self, model)

    @property
    def releases(self) -> VersionedTable:
        """(model, folder, rows) of all Gold models; the newest published release is current."""
        return VersionedTable(self.spark, f"{self.root}/gold/releases")

    @property
    def checkpoint(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/checkpoint")

    def read_checkpoint(self) -> DataFrame:
        """Offset, day and LSN of each broker partition; days are null in a checkpoint that has none yet."""
        if not self.checkpoint.exists():
            return self.spark.createDataFrame([], CHECKPOINT_SCHEMA)
        # A checkpoint of before days were kept has no such column; the given schema reads it as null.
        return self.checkpoint.read(CHECKPOINT_SCHEMA)


def commit_checkpoint(lake: Lake, batch_lsn: int, offsets: DataFrame) -> None:
    """Publish LSN and offsets. An LSN below the committed one is an error."""
    batch = lake.spark.range(1).select(F.lit(batch_lsn).cast("bigint").alias("lsn"))
    decision = m.commit_decision(lake.read_checkpoint(), batch).first()
    if not decision.committed:
        raise ValueError(
            f"The checkpoint may not go back: {decision.previous_lsn} to {decision.batch_lsn}."
        )
    lake.checkpoint.replace(offsets.withColumn("lsn", F.lit(batch_lsn).cast("bigint")))


@dataclass(frozen=True)
class Pending:
    """What has landed since the checkpoint: ranges by table, the checkpoint to write, the raw lines of a table."""

    ranges: dict[str, list[Range]]
    offsets: DataFrame
    lines: Callable[[str], DataFrame]


def run_microbatch(
    spark: SparkSession, bronze: str, lake: Lake, zone: str = "UTC", parallel_tables: int = 5,
    lateness_days: int | None = LATENESS_DAYS,
) -> BatchResult:
    """Apply the files that landed since the checkpoint. The checkpoint is written last.

    Only day folders that may hold new files are listed: from ``lateness_days`` before the newest file of
    each broker partition on. None lists all of them, for files that came later than that.

    A failure anywhere leaves the checkpoint unchanged, so the next run repeats the batch,
    and the LSN rule makes the repeat harmless. A run without new files, also
    the very first one, does nothing. Files without any event, before there is an
    LSN at all, are an error. Tables without events so far are empty. The run's own
    tables lie below the lake and go when it ends.
    """
    root = bronze.rstrip("/")
    return _run(lake, lambda run: _pending_files(spark, root, lake, run, lateness_days), zone, parallel_tables)


def run_landed_microbatch(
    spark: SparkSession, landing: str, lake: Lake, zone: str = "UTC", parallel_tables: int = 5,
    lateness_days: int | None = LATENESS_DAYS,
) -> BatchResult:
    """Apply the messages that ``land_cdc_stream`` landed as Parquet since the checkpoint, as ``run_microbatch`` does files.

    Progress is the offset of each message's broker partition, whatever files hold it. Topics, open days and
    offsets are conditions on the scan: other folders aren't listed, other row groups aren't read.
    """
    return _run(lake, lambda _: _pending_messages(spark, landing, lake, lateness_days), zone, parallel_tables)


def _run(lake: Lake, find: Callable[[str], Pending | None], zone: str, parallel: int) -> BatchResult:
    run = f"{lake.root}/_work/{uuid.uuid4().hex}"
    try:
        with released_shuffles(lake.spark):
            pending = find(run)
            return _apply_batch(lake, run, pending, zone, parallel) if pending else BatchResult(committed=False)
    finally:
        _drop(lake, run)


def _drop(lake: Lake, path: str) -> None:
    fs, folder = lake.checkpoint._file_system(path)
    fs.delete(folder, True)


def _since(previous: DataFrame, lateness_days: int | None) -> dict[str, datetime.date]:
    """The first open day by topic: one row per topic."""
    return {} if lateness_days is None else {r.topic: r.since for r in m.open_days(previous, lateness_days).collect()}


def _pending_files(
    spark: SparkSession, bronze: str, lake: Lake, run: str, lateness_days: int | None
) -> Pending | None:
    previous = lake.read_checkpoint()
    # The listing is written once, so that files landing meanwhile wait for the next run.
    days = open_day_folders(spark, bronze, _since(previous, lateness_days))
    objects = m.parse_bronze_keys(list_bronze_objects(spark, bronze, days))
    new = m.unprocessed_objects(objects, previous).withColumn("last_day", m.key_day(F.col("key")))
    new.write.parquet(f"{run}/manifest")
    selected = spark.read.schema(new.schema).parquet(f"{run}/manifest")
    if not m.has_new_files(selected):
        return None
    ranges, folders = _by_table(_offset_ranges(previous, selected)), _day_folders(selected)

    def lines(table: str) -> DataFrame:
        return scan_new_files(spark, [f"{bronze}/{f}" for f in folders[table]], ranges[table])

    return Pending(ranges, m.next_checkpoints(previous, selected), lines)


def _pending_messages(
    spark: SparkSession, landing: str, lake: Lake, lateness_days: int | None
) -> Pending | None:
    fs, folder = lake.checkpoint._file_system(landing)
    if not fs.exists(folder):
        return None
    previous, messages = lake.read_checkpoint(), scan_landed_messages(spark, landing)
    old = F.lit(False)
    for topic, day in _since(previous, lateness_days).items():
        old = old | ((F.col("topic") == topic) & (F.col("landed_day") < F.lit(day)))
    for row in previous.collect():  # one row per broker partition
        same = (F.col("topic") == row.topic) & (F.col("partition") == row.partition)
        old = old | (same & (F.col("offset") <= row.last_offset))
    messages = messages.where(~old)
    newest = messages.groupBy("topic", "partition").agg(F.max("offset").alias("start_offset"), F.max("landed_day").alias("last_day"))
    # Frozen here: one row per broker partition. What lands meanwhile has greater offsets.
    selected = spark.createDataFrame(newest.collect(), newest.schema)
    if not m.has_new_files(selected):
        return None
    ranges = _by_table(_offset_ranges(previous, selected))

    def lines(table: str) -> DataFrame:
        return drop_blank(messages.where(inside_ranges(ranges[table])).select("value"))

    return Pending(ranges, m.next_checkpoints(previous, selected), lines)


def _apply_batch(lake: Lake, run: str, pending: Pending, zone: str, parallel_tables: int) -> BatchResult:
    spark, previous = lake.spark, lake.read_checkpoint()

    def stage(table: str) -> DataFrame:
        return stage_events(pending.lines(table), lake.contracts[table], f"{run}/staged/{table}")

    staged = dict(_each(spark, stage, [t for t in lake.contracts if t in pending.ranges], parallel_tables))
    cutoff = _cutoff(previous, list(staged.values()))
    if cutoff is None:
        raise GateError("No event of the batch has an LSN, and there is no earlier one.")

    def reduce_and_apply(table: str) -> tuple[int, int]:
        # The latest versions are a written table: the upsert and the check read them several times.
        contract, path = lake.contracts[table], f"{run}/latest/{table}"
        events = at_or_below(staged[table].select(contract.columns), cutoff)
        latest[table] = latest_of_written(events, contract.primary_key, f"{run}/repeated/{table}")
        if latest[table] is not events:
            latest[table].write.options(**COMPACT).parquet(path)
            _drop(lake, f"{run}/staged/{table}")
            latest[table] = spark.read.schema(contract.schema).parquet(path)
        return lake.silver(table).apply(latest[table], fold=True)

    latest: dict[str, DataFrame] = {}
    applied = dict(_each(spark, reduce_and_apply, staged, parallel_tables))
    _check_batch(lake, latest)
    for folder in ("staged", "latest"):
        _drop(lake, f"{run}/{folder}")
    # Before Gold, which reads each table several times. One after the other: each one shuffles whole rows, and of
    # large tables each one alone keeps all cores at work.
    _each(spark, lambda table: lake.silver(table).compact(), staged, 1)
    _build_gold(lake, zone, parallel_tables)
    commit_checkpoint(lake, cutoff, pending.offsets)
    return BatchResult(True, cutoff, applied)


def _each(spark: SparkSession, work, names, parallel: int) -> list[tuple[str, object]]:
    """Run the Spark jobs of several tables side by side; the first failure ends the run."""
    names = list(names)
    with ThreadPoolExecutor(parallel) as pool:
        return list(zip(names, pool.map(inheritable_thread_target(spark)(work), names)))


def _offset_ranges(previous: DataFrame, selected: DataFrame) -> list[Range]:
    """(topic, partition, after, up to) of the batch: one row per broker partition."""
    upto = selected.groupBy("topic", "partition").agg(F.max("start_offset").alias("upto"))
    after = F.coalesce(F.col("last_offset"), F.lit(-1)).alias("after")
    joined = upto.join(previous, ["topic", "partition"], "left")
    return [tuple(row) for row in joined.select("topic", "partition", after, "upto").collect()]


def _by_table(ranges: list[Range]) -> dict[str, list[Range]]:
    tables: dict[str, list[Range]] = {}
    for entry in ranges:
        tables.setdefault(entry[0].rsplit(".", 1)[-1], []).append(entry)
    return tables


def _day_folders(selected: DataFrame) -> dict[str, list[str]]:
    """The day folders of the batch by table: one row per topic and day."""
    folder = F.regexp_replace("key", "/[^/]+$", "").alias("folder")
    folders: dict[str, list[str]] = {}
    for row in selected.select("table", folder).distinct().orderBy("folder").collect():
        folders.setdefault(row.table, []).append(row.folder)
    return folders


def _cutoff(previous: DataFrame, staged: list[DataFrame]) -> int | None:
    lsns = previous.select("lsn")
    for events in staged:
        lsns = lsns.unionByName(events.select(F.col(LSN).alias("lsn")))
    return lsns.agg(F.max("lsn")).first()[0]


def _check_batch(lake: Lake, latest: dict[str, DataFrame]) -> None:
    keys = {table: lake.contracts[table].primary_key for table in latest}
    stored = {t: lake.silver(t).near(df, list(_state_columns(keys[t]))) for t, df in latest.items()}
    ledger = lake.silver("ledger_entries").read(["amount", "_cdc_deleted"])
    report = reconcile_batch(latest, stored, keys, ledger).where("NOT in_sync").collect()
    if report:
        raise GateError("Batch not reflected in the state: " + "; ".join(r.item for r in report))


def _state_columns(key: str) -> tuple[str, str, str]:
    return key, LSN, "_cdc_deleted"


def _build_gold(lake: Lake, zone: str, parallel: int) -> None:
    """Write every model, test what was written, then release all of them by one marker, or none."""
    staging = staging_models({t: lake.silver(t).read() for t in lake.contracts})
    models = {name: observed(name, df) for name, df in build_gold(staging, zone).items()}
    written = dict(
        _each(lake.spark, lambda name: lake.gold(name).write_state(models[name][0]), models, parallel)
    )
    tables = {name: lake.gold(name).read_write(write) for name, write in written.items()}
    passed = passed_tests(seen for _, seen in models.values())
    failed = gold_quality_report(tables, staging, zone, passed).where("failures > 0").collect()
    if failed:
        raise GateError("Data tests failed: " + "; ".join(f"{r.test}={r.failures}" for r in failed))
    rows = [(name, write.name, write.rows) for name, write in written.items()]
    lake.releases.replace(lake.spark.createDataFrame(rows, "model STRING, folder STRING, rows BIGINT").coalesce(1))
