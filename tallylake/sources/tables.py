"""Current-state tables kept as published Parquet states.

A write goes to a folder of its own name and counts only once its marker, which
holds that name, exists; a lost job or a second writer leaves nothing a reader can
see and overwrites nothing. Markers need a file system that creates a file only if
it isn't there (HDFS, local and NFS do; a plain object store doesn't). On a catalog
with row-level MERGE, ``merge_into_catalog`` does the same upsert.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.contracts import DELETED, LSN, TableContract
from tallylake.functions.clock import utc_day
from tallylake.operators.latest import accepted_versions
from tallylake.session import COMPACT

STATE, CHANGES = "state", "changes"


class SchemaMismatch(TypeError):
    """A stored table has not the columns of its contract."""


class Write(NamedTuple):
    """A finished write: its version, kind, row count and folder name."""

    version: int
    kind: str
    rows: int
    name: str


class VersionedTable:
    """Full states of one table; the newest published one is current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file_system(self, path: str):
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm_path

    def writes(self) -> list[Write]:
        """The published writes, oldest first."""
        fs, folder = self._file_system(f"{self.path}/published")
        if not fs.exists(folder):
            return []
        names = [fs_status.getPath().getName() for fs_status in fs.listStatus(folder)]
        found = []
        for name in names:
            if name[0].isdigit():
                version, kind, rows, unique = name.split("-")
                found.append(Write(int(version), kind, int(rows), f"{version}-{kind}-{unique}"))
        return sorted(found)

    def published(self) -> list[tuple[int, str, int]]:
        """(version, kind, rows) of each published write, oldest first."""
        return [(w.version, w.kind, w.rows) for w in self.writes()]

    def exists(self) -> bool:
        return bool(self.published())

    def folder(self, write: Write) -> str:
        return f"{self.path}/{write.name}"

    def next_version(self) -> int:
        published = self.published()
        return published[-1][0] + 1 if published else 1

    def publish(self, write: Write) -> None:
        """Make a write count. Of two writers of one version the second one fails, and its files stay unread."""
        fs, claim = self._file_system(f"{self.path}/published/_claims/{write.version:010d}")
        if not fs.createNewFile(claim):
            raise RuntimeError(f"Version {write.version} of {self.path} was published by another writer.")
        unique = write.name.rsplit("-", 1)[1]
        marker = self._file_system(f"{self.path}/published/{write.version:010d}-{write.kind}-{write.rows}-{unique}")[1]
        if not fs.createNewFile(marker):
            raise RuntimeError(f"{write.name} of {self.path} was published before.")

    def _new_write(self, df: DataFrame, kind: str, day_column: str | None = None) -> Write:
        version = self.next_version()
        name = f"{version:010d}-{kind}-{uuid.uuid4().hex}"
        _write(df, f"{self.path}/{name}", day_column)
        return Write(version, kind, self._written_rows(df.schema, f"{self.path}/{name}"), name)

    def write_state(self, df: DataFrame, day_column: str | None = None) -> Write:
        """Write a full state without publishing it."""
        return self._new_write(df, STATE, day_column)

    def vacuum(self, keep: int = 2) -> int:
        """Delete published writes that only states older than the newest ``keep`` need. Returns how many.

        Readers of such an old state must be done. Unpublished folders stay, as a writer may be at work.
        """
        writes = self.writes()
        states = [w for w in writes if w.kind == STATE]
        if len(states) <= keep:
            return 0
        old = [w for w in writes if w.version < states[-keep].version]
        for write in old:
            fs, folder = self._file_system(self.folder(write))
            unique = write.name.rsplit("-", 1)[1]
            # The marker goes first, so no reader finds one without its files.
            fs.delete(self._file_system(f"{self.path}/published/{write.version:010d}-{write.kind}-{write.rows}-{unique}")[1], False)
            fs.delete(folder, True)
        return len(old)

    def _written_rows(self, schema: T.StructType, path: str) -> int:
        """Row count of a finished write, from its file footers."""
        return self.spark.read.schema(schema).parquet(path).count()

    def replace(self, df: DataFrame) -> int:
        """Full rebuild: write a new state, then publish it. Returns its row count."""
        write = self.write_state(df)
        self.publish(write)
        return write.rows

    def move(self, path: str) -> VersionedTable:
        """Rename the whole table. An existing target is never replaced."""
        fs, target = self._file_system(path)
        if fs.exists(target):
            raise FileExistsError(f"{path} exists.")
        fs.mkdirs(target.getParent())
        if not fs.rename(self._file_system(self.path)[1], target):
            raise RuntimeError(f"{self.path} could not be moved to {path}.")
        return VersionedTable(self.spark, path)

    def read_write(self, write: Write) -> DataFrame:
        return self.spark.read.parquet(self.folder(write))

    def read(self, schema: str | None = None) -> DataFrame:
        """The newest published state; columns of ``schema`` that it hasn't are null."""
        states = [write for write in self.writes() if write.kind == STATE]
        if not states:
            raise FileNotFoundError(f"No published state in {self.path}.")
        if schema is not None:
            return self.spark.read.schema(schema).parquet(self.folder(states[-1]))
        return self.read_write(states[-1])


def _day_name(column: str) -> str:
    return f"{column}_day"


def _write(df: DataFrame, path: str, day_column: str | None = None) -> None:
    writer = df
    if day_column is not None:
        # REBALANCE puts a day's rows together but still splits a large day into several files.
        day = _day_name(day_column)
        writer = df.withColumn(day, utc_day(F.col(day_column))).hint("rebalance", F.col(day))
    out = writer.write.mode("overwrite").options(**COMPACT)
    if day_column is not None:
        out = out.partitionBy(_day_name(day_column))
    out.parquet(path)


class SilverTable(VersionedTable):
    """One row per key with a guarded upsert: only a strictly greater LSN replaces a row.

    A batch costs what it accepts: accepted rows are written beside the last
    full state as a change set, and readers overlay them. ``compact`` folds the
    change sets into a new state once they are worth it.
    """

    #: Fold once the change sets hold this share of the state's rows, or are this many.
    FOLD_SHARE, FOLD_SETS = 0.25, 16
    #: A batch of this share of the stored rows meets them without a semi join before.
    NEAR_SHARE = 0.1
    #: Batches up to so many rows are joined whole. Up to so many keys, of rows refused or kept, are broadcast.
    SMALL_BATCH, FEW_KEYS = 100_000, 500_000

    def __init__(self, spark: SparkSession, path: str, contract: TableContract):
        super().__init__(spark, path)
        self.contract = contract
        self._guarded: set[str] = set()

    def _guard(self, write: Write) -> None:
        """Stored columns must be those of the contract: none missing, renamed or of another type."""
        if write.name in self._guarded:
            return
        stored = {f.name: f.dataType for f in self.read_write(write).schema.fields}
        faults = [
            f"{f.name}: {stored[f.name].simpleString() if f.name in stored else 'missing'}, not {f.dataType.simpleString()}"
            for f in self.contract.schema.fields
            if stored.get(f.name) != f.dataType
        ]
        day = _day_name(self.contract.day_column) if self.contract.day_column else None
        faults += [f"{name}: not in the contract" for name in stored if name not in self.contract.columns and name != day]
        if faults:
            raise SchemaMismatch(f"{self.path} differs from the contract of {self.contract.name}: " + "; ".join(faults))
        self._guarded.add(write.name)

    def _layers(self) -> tuple[DataFrame | None, list[DataFrame]]:
        writes = self.writes()
        states = [write for write in writes if write.kind == STATE]
        if not states:
            return None, []
        changed = [write for write in writes if write.kind == CHANGES and write.version > states[-1].version]
        for write in [states[-1], *changed]:
            self._guard(write)
        fields = list(self.contract.schema.fields)
        if self.contract.day_column:
            fields.append(T.StructField(_day_name(self.contract.day_column), T.DateType()))
        reader = self.spark.read
        state = reader.schema(T.StructType(fields)).parquet(self.folder(states[-1]))
        changes = [reader.schema(self.contract.schema).parquet(self.folder(write)) for write in changed]
        return state, changes

    def read(
        self,
        columns: list[str] | None = None,
        live_only: bool = False,
        days: tuple[str, str] | None = None,
    ) -> DataFrame:
        """The current state. Columns, the live filter and the day range reach the file scan.

        A table that nothing was applied to is an empty one. One that differs from its contract is an error.
        """
        contract, key = self.contract, self.contract.primary_key
        state, changes = self._layers()
        columns = columns or contract.columns
        if state is None:
            return self.spark.createDataFrame([], contract.schema).select(columns)
        live = F.col(DELETED) == F.lit(False)
        if days is not None:
            first, last = (F.lit(day).cast("date") for day in days)
            state = state.where(F.col(_day_name(contract.day_column)).between(first, last))
        if live_only:
            state = state.where(live)
        current = state.select(list(dict.fromkeys([key, *columns])))
        if changes:
            newer = self._newest(changes, [*columns, DELETED, contract.day_column or key])
            if days is not None:
                newer = newer.where(utc_day(F.col(contract.day_column)).between(first, last))
            if live_only:
                newer = newer.where(live)
            keys = reduce(DataFrame.unionByName, [c.select(key) for c in changes])
            current = current.join(keys, key, "left_anti").unionByName(newer.select(current.columns))
        return current.select(columns)

    def _newest(self, layers: list[DataFrame], columns: list[str]) -> DataFrame:
        """The row with the greatest LSN per key of several layers.

        A layer has a key once, and never with the LSN of another layer, so the
        LSN alone decides and only the named columns are read.
        """
        key = self.contract.primary_key
        wanted = list(dict.fromkeys([key, LSN, *columns]))
        layers = [layer.select(wanted) for layer in layers]
        if len(layers) == 1:
            return layers[0]
        order = Window.partitionBy(key).orderBy(F.col(LSN).desc())
        ranked = reduce(DataFrame.unionByName, layers).withColumn("_rank", F.row_number().over(order))
        return ranked.where("_rank = 1").drop("_rank")

    def lookup(self, keys: DataFrame, columns: list[str]) -> DataFrame:
        """The current rows of the given keys only.

        Each layer is first cut to those keys by a semi join, whose right side
        Spark broadcasts when its files are below the broadcast threshold; a
        small batch then never shuffles the table.
        """
        key = self.contract.primary_key
        wanted = list(dict.fromkeys([key, LSN, *columns]))
        state, changes = self._layers()
        if state is None:
            # Known to be empty when planned, so a first load is not joined at all.
            types = [self.contract.schema[c].dataType for c in wanted]
            nothing = [F.lit(None).cast(t).alias(c) for c, t in zip(wanted, types)]
            return self.spark.range(1).select(nothing).where(F.lit(False))
        keys = keys.select(key)
        layers = [layer.join(keys, key, "left_semi") for layer in [state, *changes]]
        return self._newest(layers, wanted)

    def _stored_rows(self) -> tuple[int, int, int]:
        """Rows of the newest full state and of the change sets behind it, and how many these are."""
        published = self.published()
        states = [entry for entry in published if entry[1] == STATE]
        if not states:
            return 0, 0, 0
        changes = [entry for entry in published if entry[0] > states[-1][0]]
        return states[-1][2], sum(entry[2] for entry in changes), len(changes)

    def near(self, batch: DataFrame, columns: list[str]) -> DataFrame:
        """Current rows, those of the batch's keys among them: ``lookup``, or all rows where the batch isn't small beside them.

        For a left join of the batch, to which other rows make no difference.
        """
        state, changes = self._layers()
        if state is None or batch.count() < self.NEAR_SHARE * sum(self._stored_rows()[:2]):
            return self.lookup(batch, columns)
        wanted = list(dict.fromkeys([self.contract.primary_key, LSN, *columns]))
        return self._newest([state, *changes], wanted)

    def apply(self, batch: DataFrame, fold: bool = False) -> tuple[int, int]:
        """Upsert a batch with one row per key. Returns (applied, ignored).

        Nothing is published when no row is accepted, so a replay leaves the
        table as it is. The batch is read several times; pass a written one.
        With ``fold``, a large batch after which ``compact`` would be due gives the new full state at once.
        """
        batch, work = batch.select(self.contract.columns), f"{self.path}/_work-{uuid.uuid4().hex}"
        rows = batch.count()
        try:
            if rows > self.SMALL_BATCH and self.exists():
                return self._apply_large(batch, rows, fold, work)
            return self._apply_judged(batch, rows)
        finally:
            fs, folder = self._file_system(work)
            fs.delete(folder, True)

    def _apply_judged(self, batch: DataFrame, rows: int) -> tuple[int, int]:
        key = self.contract.primary_key
        judged = accepted_versions(batch, self.lookup(batch, [key, LSN]), key)
        accepted = judged.where("accepted").select(self.contract.columns)
        first = not self.exists()
        write = self._new_write(accepted, STATE if first else CHANGES, self.contract.day_column if first else None)
        if write.rows:
            self.publish(write)
        return write.rows, rows - write.rows

    def _apply_large(self, batch: DataFrame, rows: int, fold: bool, work: str) -> tuple[int, int]:
        """Only keys and LSNs of the batch meet the stored ones. What is refused is written to ``work``; the batch is
        shuffled whole only where that is too much to broadcast."""
        key = self.contract.primary_key
        narrow = batch.select(key, LSN)
        judged = accepted_versions(narrow, self.near(narrow, [key, LSN]), key)
        refused = self._kept(judged.where(~F.coalesce("accepted", F.lit(False))).select(key, LSN), f"{work}/refused")
        n_refused = refused.count()
        if n_refused > self.FEW_KEYS:
            return self._apply_judged(batch, rows)
        accepted, taken = batch, rows - n_refused
        if not taken:
            return 0, rows
        if n_refused:
            refused = F.broadcast(refused.select(F.col(key).alias("_key"), F.col(LSN).alias("_lsn")))
            accepted = batch.join(refused, F.col(key).eqNullSafe(F.col("_key")) & F.col(LSN).eqNullSafe(F.col("_lsn")), "left_anti")
        if fold and self._fold_due(taken):
            self.publish(self.write_state(self._merged(accepted, taken, work), self.contract.day_column))
        else:
            self.publish(self._new_write(accepted, CHANGES))
        return taken, n_refused

    def _merged(self, accepted: DataFrame, taken: int, work: str) -> DataFrame:
        """The current state with ``taken`` accepted rows in place of what they replace.

        Where so few stored rows can stay that their keys can be broadcast, these are written to ``work``, and no whole
        row is shuffled for it.
        """
        key, current = self.contract.primary_key, self.read()
        if sum(self._stored_rows()[:2]) - taken <= self.FEW_KEYS:
            stays = self._kept(self.read([key]).join(accepted.select(key), key, "left_anti"), f"{work}/stays")
            n_stays = stays.count()
            if not n_stays:
                return accepted
            if n_stays <= self.FEW_KEYS:
                stays = F.broadcast(stays.select(F.col(key).alias("_key")))
                return current.join(stays, F.col(key).eqNullSafe(F.col("_key")), "left_semi").unionByName(accepted)
        return current.join(accepted.select(key), key, "left_anti").unionByName(accepted)

    def _kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.options(**COMPACT).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _fold_due(self, more: int = 0) -> bool:
        """Whether the change sets, and one of ``more`` rows besides, are worth a new full state."""
        rows, changed, sets = self._stored_rows()
        return changed + more > self.FOLD_SHARE * rows or sets + bool(more) >= self.FOLD_SETS

    def compact(self, force: bool = False) -> bool:
        """Fold the change sets into a new full state if that is due."""
        if not self._stored_rows()[2] or not (force or self._fold_due()):
            return False
        self.publish(self.write_state(self.read(), self.contract.day_column))
        return True


def merge_into_catalog(batch: DataFrame, table: str, primary_key: str) -> None:
    """The same guarded upsert as one MERGE, for catalogs whose tables support it."""
    merge = batch.alias("s").mergeInto(table, _same_key(table, primary_key))
    newer = F.col(f"s.{LSN}") > F.col(f"{table}.{LSN}")
    merge.whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()


def _same_key(table: str, primary_key: str) -> Column:
    return F.col(f"s.{primary_key}") == F.col(f"{table}.{primary_key}")
