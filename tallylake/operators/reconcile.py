"""Layer-to-layer reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.contracts import DELETED, LSN

TOTAL = "decimal(38,4)"


def max_lsn(events: dict[str, DataFrame]) -> DataFrame:
    """(table, max_lsn) over the tables that have any LSN."""
    parts = [
        df.select(F.lit(table).alias("table"), F.col(LSN).alias("lsn"))
        for table, df in events.items()
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("table")
        .agg(F.max("lsn").alias("max_lsn"))
        .where("max_lsn IS NOT NULL")
    )


def capture_cutoff(events: dict[str, DataFrame]) -> DataFrame:
    """One row: the highest visible LSN, NULL when there is none."""
    return max_lsn(events).agg(F.max("max_lsn").alias("cutoff_lsn"))


def active_counts(states: dict[str, DataFrame], alias: str = "live_rows") -> DataFrame:
    """(table, live rows) over current states; a tombstone is not live."""
    parts = [
        df.agg(F.count_if(~F.col(DELETED)).alias(alias)).select(F.lit(table).alias("table"), alias)
        for table, df in states.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def ledger_total(ledger: DataFrame) -> DataFrame:
    """One row: sum of live entries over all currencies, 0 for none."""
    return ledger.where(F.col(DELETED) == F.lit(False)).agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast(TOTAL).alias("ledger_total")
    )


def _compared(left: dict[str, DataFrame]) -> DataFrame:
    """Counts of several layers side by side, joined by table."""
    layers = iter(left.values())
    joined = next(layers)
    for layer in layers:
        joined = joined.join(layer, "table", "full_outer")
    return joined


def _report(counts: DataFrame, totals: dict[str, DataFrame], layers: list[str]) -> DataFrame:
    """Count rows, then the ledger row, each with ``in_sync``."""
    same = reduce(lambda a, b: a & b, [F.col(layers[0]).eqNullSafe(F.col(x)) for x in layers[1:]])
    rows = counts.select(
        F.concat(F.lit("rows:"), F.col("table")).alias("item"),
        *[F.col(x).cast(TOTAL).alias(x) for x in layers],
        same.alias("in_sync"),
    )
    present = [x for x in layers if x in totals]
    first = totals[present[0]].select(F.col("ledger_total").alias(present[0]))
    for layer in present[1:]:
        first = first.withColumn(layer, totals[layer].select("ledger_total").scalar())
    zero = reduce(lambda a, b: a & b, [F.col(x) == 0 for x in present])
    ledger = first.withColumn("in_sync", zero).select(
        F.lit("ledger_total").alias("item"),
        *[(F.col(x) if x in present else F.lit(None)).cast(TOTAL).alias(x) for x in layers],
        "in_sync",
    )
    return rows.unionByName(ledger)


def reconcile_layers(
    source: dict[str, DataFrame], bronze: dict[str, DataFrame], silver: dict[str, DataFrame]
) -> DataFrame:
    """(item, source, bronze, silver, in_sync): live rows per table, then the ledger totals.

    ``bronze`` holds the latest event per key. The source has no tombstones. The
    ledger must be zero in the source and in the state.
    """
    source_counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("source")).select(F.lit(t).alias("table"), "source")
            for t, df in source.items()
        ],
    )
    counts = _compared({
        "source": source_counts,
        "bronze": active_counts(bronze, "bronze"),
        "silver": active_counts(silver, "silver"),
    })
    source_total = source["ledger_entries"].agg(
        F.coalesce(F.sum("amount"), F.lit(0)).cast(TOTAL).alias("ledger_total")
    )
    totals = {"source": source_total, "silver": ledger_total(silver["ledger_entries"])}
    return _report(counts, totals, ["source", "bronze", "silver"])


def reconcile_cutoff(
    bronze: dict[str, DataFrame],
    silver: dict[str, DataFrame],
    cutoff: int | None = None,
    cut_silver: bool = False,
) -> DataFrame:
    """(item, bronze, silver, in_sync) with ``bronze`` already cut to an LSN.

    The state is compared as it is, so one that has moved past the cutoff shows
    as a difference. ``cut_silver`` leaves its newer rows out instead: they
    cannot be rolled back, so ``rows_past_cutoff`` reports them separately.
    """
    if cut_silver:
        silver = {t: df.where(F.col(LSN) <= cutoff) for t, df in silver.items()}
    counts = _compared({
        "bronze": active_counts(bronze, "bronze"),
        "silver": active_counts(silver, "silver"),
    })
    totals = {
        "bronze": ledger_total(bronze["ledger_entries"]),
        "silver": ledger_total(silver["ledger_entries"]),
    }
    return _report(counts, totals, ["bronze", "silver"])


def rows_past_cutoff(silver: dict[str, DataFrame], cutoff: int) -> DataFrame:
    """(table, rows) of the state newer than the cutoff."""
    parts = [
        df.agg(F.count_if(F.col(LSN) > cutoff).alias("rows")).select(
            F.lit(table).alias("table"), "rows"
        )
        for table, df in silver.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# The three ways a batch key can be wrong in the state.
ABSENT, OLDER, TOMBSTONE = "absent", "older_lsn", "tombstone_differs"


def batch_state_failures(latest: DataFrame, stored: DataFrame, primary_key: str) -> DataFrame:
    """(key, reason, lsn, stored_lsn) of batch keys the state does not reflect.

    A state newer than the batch is fine.
    """
    current = stored.select(
        primary_key,
        F.col(LSN).alias("stored_lsn"),
        F.col(DELETED).alias("stored_deleted"),
        F.lit(True).alias("found"),
    )
    reason = (
        F.when(F.col("found").isNull(), ABSENT)
        .when(F.col("stored_lsn") < F.col(LSN), OLDER)
        .when(
            (F.col("stored_lsn") == F.col(LSN)) & (F.col("stored_deleted") != F.col(DELETED)),
            TOMBSTONE,
        )
    )
    return (
        latest.select(primary_key, LSN, DELETED)
        .join(current, primary_key, "left")
        .select(
            F.col(primary_key).alias("key"), reason.alias("reason"),
            F.col(LSN).alias("lsn"), "stored_lsn",
        )
        .where("reason IS NOT NULL")
    )


def failure_sample(failures: DataFrame, size: int = 10) -> DataFrame:
    """The first failures by key: a report, not the verdict."""
    return failures.orderBy("key", "reason").limit(size)


def reconcile_batch(
    latest: dict[str, DataFrame],
    stored: dict[str, DataFrame],
    keys: dict[str, str],
    ledger: DataFrame,
) -> DataFrame:
    """(item, checked, failures, in_sync): the batch keys per table, then the zero sum.

    ``stored`` holds only the state rows of the batch's keys.
    """
    parts = []
    for table, batch in latest.items():
        failures = batch_state_failures(batch, stored[table], keys[table])
        checked = batch.agg(F.count(F.lit(1)).alias("checked"))
        failed = failures.agg(F.count(F.lit(1)).alias("failures")).scalar()
        parts.append(
            checked.select(
                F.lit(f"keys:{table}").alias("item"),
                F.col("checked").cast(TOTAL).alias("checked"),
                failed.alias("failures"),
            ).withColumn("in_sync", F.col("failures") == 0)
        )
    total = ledger_total(ledger).select(
        F.lit("ledger_total").alias("item"),
        F.col("ledger_total").alias("checked"),
        F.when(F.col("ledger_total") != 0, 1).otherwise(0).cast("bigint").alias("failures"),
        (F.col("ledger_total") == 0).alias("in_sync"),
    )
    return reduce(DataFrame.unionByName, [*parts, total])
