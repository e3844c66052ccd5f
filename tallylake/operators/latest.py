"""Latest version per key, and which incoming versions a stored state accepts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallylake.contracts import LSN
from tallylake.session import COMPACT

#: Hashes of repeated keys are broadcast up to so many of them: some 100 MB as a hash table.
FEW_KEYS = 1 << 22
#: ... and up to this share of the rows.
FEW_SHARE = 0.125


def at_or_below(events: DataFrame, max_lsn: int | None) -> DataFrame:
    """Events up to the cutoff. Comes after validation and before the latest version is taken."""
    return events if max_lsn is None else events.where(F.col(LSN) <= max_lsn)


def latest_by_lsn(events: DataFrame, primary_key: str, lsn: str = LSN) -> DataFrame:
    """The event with the greatest LSN of every key; deletes stay as rows.

    Two events of a key with one LSN are told apart by their remaining columns,
    so the result does not depend on row order. Spark keeps rank 1 within each
    task before the shuffle, so a key that holds much of the input sends one
    row per task.
    """
    ties = [F.col(c) for c in events.columns if c not in (primary_key, lsn)]
    order = Window.partitionBy(primary_key).orderBy(F.col(lsn).desc(), *ties)
    ranked = events.withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank")


def repeated_keys(events: DataFrame, primary_key: str) -> DataFrame:
    """``hash`` of every key that comes more than once; of keys that share one by chance as well."""
    hashes = events.groupBy(F.xxhash64(primary_key).alias("hash")).agg(F.count(F.lit(1)).alias("n"))
    return hashes.where("n > 1").select("hash")


def latest_beside(events: DataFrame, primary_key: str, repeated: DataFrame) -> DataFrame:
    """``latest_by_lsn`` by the hashes of all keys that come more than once, which are broadcast; other rows aren't shuffled."""
    marked, hashes = events.withColumn("_hash", F.xxhash64(primary_key)), F.broadcast(repeated.select(F.col("hash").alias("_hash")))
    once = marked.join(hashes, "_hash", "left_anti").select(events.columns)
    more = marked.join(hashes, "_hash", "left_semi").select(events.columns)
    return once.unionByName(latest_by_lsn(more, primary_key))


def latest_of_written(events: DataFrame, primary_key: str, path: str) -> DataFrame:
    """``latest_by_lsn`` of written events, as they are if no key comes twice. ``path`` gets the hashes of repeated keys.

    Of most rows only the key's hash is shuffled, not the whole row. With more repeated keys than can be
    broadcast, or so many that most rows have one, all rows are.
    """
    repeated_keys(events, primary_key).write.options(**COMPACT).parquet(path)
    repeated = events.sparkSession.read.schema("hash BIGINT").parquet(path)
    count = repeated.count()
    if not count:
        return events
    few = count <= FEW_KEYS and count <= FEW_SHARE * events.count()
    return latest_beside(events, primary_key, repeated) if few else latest_by_lsn(events, primary_key)


def accepted_versions(batch: DataFrame, stored: DataFrame, primary_key: str) -> DataFrame:
    """The batch with ``accepted``: key unknown, or LSN strictly above the stored one."""
    known = stored.select(primary_key, F.col(LSN).alias("stored_lsn"))
    verdict = F.col("stored_lsn").isNull() | (F.col(LSN) > F.col("stored_lsn"))
    return batch.join(known, primary_key, "left").withColumn("accepted", verdict)
