"""Raw aircraft snapshots: object bytes with their recorded metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.functions.clock import utc_clock
from tallylake.sources.bronze import listing_roots, relative_key


def scan_snapshots(
    spark: SparkSession, root: str, metadata: DataFrame, pattern: str = "*"
) -> DataFrame:
    """Exact bytes of each object with its metadata map.

    ``metadata`` has (object_key, metadata MAP). An object without a metadata
    row keeps a NULL map, which the integrity check refuses.
    """
    objects = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(listing_roots(spark, root))
        .select(
            relative_key(F.col("path"), root).alias("object_key"),
            F.col("length").alias("stored_size"),
            "content",
        )
    )
    return objects.join(metadata, "object_key", "left")


def land_snapshots(snapshots: DataFrame, path: str) -> None:
    """Append collected snapshots below ``dt=/hour=`` of their UTC collection time.

    The body stays as the bytes received, next to its metadata.
    """
    clock = utc_clock(F.col("collected_at"))
    (
        snapshots.withColumn("dt", F.to_date(clock))
        .withColumn("hour", F.lpad(F.hour(clock).cast("string"), 2, "0"))
        .hint("rebalance", F.col("dt"), F.col("hour"))
        .write.mode("append")
        .partitionBy("dt", "hour")
        .parquet(path)
    )
