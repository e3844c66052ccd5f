"""Jobs on a lake beside the micro-batch: one table from landed files, and reconciliation."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.contracts import DELETED
from tallylake.operators import reconcile as r
from tallylake.operators.envelope import normalise_events, stage_events
from tallylake.operators.latest import at_or_below, latest_by_lsn, latest_of_written
from tallylake.plans.pipeline import Lake
from tallylake.session import COMPACT, released_shuffles
from tallylake.sources.bronze import scan_bronze_paths


def _folder(bronze: str, table: str) -> str:
    return f"{bronze.rstrip('/')}/topics/cdc.public.{table}"


def apply_table(
    lake: Lake, bronze: str, table: str, date: str | None = None, max_lsn: int | None = None,
    files: Sequence[str] | None = None,
) -> tuple[int, int]:
    """Apply landed events of one table: all of them, those of a day, or those of some files; up to an LSN.

    For a replay or a backfill. All events read are checked before anything is applied, and the LSN rule
    makes a repeat harmless. The checkpoint isn't touched. Returns (applied, ignored).
    """
    contract, work = lake.contracts[table], f"{lake.root}/_work/{uuid.uuid4().hex}"
    try:
        with released_shuffles(lake.spark):
            lines = scan_bronze_paths(lake.spark, _folder(bronze, table), date=date, files=files)
            events = at_or_below(stage_events(lines, contract, f"{work}/staged").select(contract.columns), max_lsn)
            latest = latest_of_written(events, contract.primary_key, f"{work}/repeated")
            if latest is not events:
                latest.write.options(**COMPACT).parquet(f"{work}/latest")
                latest = lake.spark.read.schema(contract.schema).parquet(f"{work}/latest")
            return lake.silver(table).apply(latest)
    finally:
        fs, folder = lake.checkpoint._file_system(work)
        fs.delete(folder, True)


def landed_versions(lake: Lake, bronze: str, cutoff: int | None = None) -> dict[str, DataFrame]:
    """The latest landed version of every key, up to the cutoff."""
    latest = {}
    for name, contract in lake.contracts.items():
        events = normalise_events(scan_bronze_paths(lake.spark, _folder(bronze, name)), contract)
        latest[name] = latest_by_lsn(at_or_below(events.select(contract.columns), cutoff), contract.primary_key)
    return latest


def reconcile_lake(
    lake: Lake, bronze: str, source: dict[str, DataFrame] | None = None, cutoff: int | None = None
) -> DataFrame:
    """Rows and ledger totals of source, landed events and state side by side, or of the last two at a cutoff.

    ``source`` has the tables as the source holds them, where rows marked deleted don't count; without it
    the landed events up to ``cutoff`` are compared with the state.
    """
    landed = landed_versions(lake, bronze, cutoff)
    states = {name: lake.silver(name).read() for name in lake.contracts}
    if source is None:
        return r.reconcile_cutoff(landed, states)
    live = {name: df.where(~F.col(DELETED)) if DELETED in df.columns else df for name, df in source.items()}
    return r.reconcile_layers(live, landed, states)
