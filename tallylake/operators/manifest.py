"""Incremental progress: which landed objects are new, and what to remember afterwards.

Checkpoints are rows (topic, partition, last_offset): one per broker partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed pattern of an object key; the topic must repeat in the file name. The sink may compress its files.
OBJECT_KEY = r"^topics/([^/]+)/year=\d{4}/month=\d{2}/day=\d{2}/\1\+(\d+)\+(\d+)\.json(\.gz)?\z"

CHECKPOINT_SCHEMA = "topic STRING, partition BIGINT, last_offset BIGINT"


def parse_bronze_keys(objects: DataFrame, bucket: str = "s3://bronze") -> DataFrame:
    """Topic, partition, first offset, table and URI of each object; other keys are ignored."""
    key = F.col("key")
    # The pattern is matched once. The casts may be evaluated for other keys too, so they must not fail there.
    topic = F.split_part(key, F.lit("/"), F.lit(2))
    name = F.substring_index(F.substring_index(key, "/", -1), ".json", 1)
    return objects.where(key.rlike(OBJECT_KEY)).select(
        "key",
        topic.alias("topic"),
        F.substring_index(F.substring_index(name, "+", -2), "+", 1).try_cast("bigint").alias("partition"),
        F.substring_index(name, "+", -1).try_cast("bigint").alias("start_offset"),
        F.substring_index(topic, ".", -1).alias("table"),
        F.concat(F.lit(bucket.rstrip("/") + "/"), key).alias("uri"),
    )


def unprocessed_objects(objects: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Parsed objects that start after the checkpoint of their topic and partition."""
    last = F.coalesce(F.col("last_offset"), F.lit(-1))
    return (
        objects.join(checkpoints, ["topic", "partition"], "left")
        .where(F.col("start_offset") > last)
        .select(objects.columns)
    )


def batch_manifest(selected: DataFrame, known_tables: list[str]) -> DataFrame:
    """The new files as rows, one per file, marked with whether a contract covers the table.

    Files of other tables are listed and advance the offsets, but are not applied.
    """
    return selected.select(
        "table",
        F.col("table").isin(known_tables).alias("has_contract"),
        "topic",
        "partition",
        "start_offset",
        "uri",
    )


def manifest_order(objects: DataFrame, work: str) -> DataFrame:
    """Objects with their ``position`` by topic, partition, numeric offset and key, sorted.

    Rows are dealt out by ranges of the order, so a broker partition of any size, with offsets as sparse
    as may be, spreads over many tasks. Each task numbers its own range and the ranges are written to the
    folder ``work`` once; the positions before a range are a prefix sum over one row per range.
    """
    spark, order = objects.sparkSession, ["topic", "partition", "start_offset", "key"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The id holds the range in its upper bits and the row's place in the range in the lower 33.
    dealt = objects.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    dealt.write.parquet(work)
    numbered = spark.read.schema(dealt.schema).parquet(work).withColumns({
        "_range": F.shiftright("_id", 33), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    sizes = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_before"))
    position = (F.col("_before") + F.col("_place") + 1).alias("position")
    return numbered.join(F.broadcast(starts), "_range").select(*objects.columns, position).orderBy("position")


def key_day(key: Column) -> Column:
    """The day of the folder that an object key lies in."""
    parts = (F.regexp_extract(key, rf"/{name}=(\d+)/", 1) for name in ("year", "month", "day"))
    return F.concat_ws("-", *parts).try_cast("date")


def next_checkpoints(checkpoints: DataFrame, selected: DataFrame) -> DataFrame:
    """Greatest offset, and where both sides have it greatest ``last_day``, old or new, of every topic and partition."""
    kept = ["last_offset"] + ["last_day"] * ("last_day" in checkpoints.columns and "last_day" in selected.columns)
    new = selected.withColumn("last_offset", F.col("start_offset")).select("topic", "partition", *kept)
    rows = checkpoints.select("topic", "partition", *kept).unionByName(new)
    return rows.groupBy("topic", "partition").agg(*(F.max(c).alias(c) for c in kept))


def open_days(checkpoints: DataFrame, lateness_days: int) -> DataFrame:
    """topic, since: the first day whose folder may get files yet, for topics whose every partition has a day.

    The next file of a partition lies at most ``lateness_days`` before the newest one it has had. A partition
    that gets no files keeps its topic's days open from there on.
    """
    days = checkpoints.groupBy("topic").agg(F.min("last_day").alias("first"), F.count_if(F.col("last_day").isNull()).alias("unknown"))
    return days.where("unknown = 0").select("topic", F.date_sub("first", lateness_days).alias("since"))


def has_new_files(selected: DataFrame) -> bool:
    return not selected.isEmpty()


def commit_decision(previous: DataFrame, batch_lsn: DataFrame) -> DataFrame:
    """One row (previous_lsn, batch_lsn, committed): the LSN may stay or grow, not go back.

    With no previous checkpoint any LSN may be committed.
    """
    return (
        previous.agg(F.max("lsn").alias("previous_lsn"))
        .select("previous_lsn", batch_lsn.select("lsn").scalar().alias("batch_lsn"))
        .withColumn(
            "committed",
            F.col("batch_lsn").isNotNull()
            & (F.col("previous_lsn").isNull() | (F.col("batch_lsn") >= F.col("previous_lsn"))),
        )
    )
