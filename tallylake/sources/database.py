"""The transactional source, read only for reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def source_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A source table over JDBC. Counts and sums on it are pushed down to the database.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` to read rows in parallel.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, pushDownAggregate="true", **options)
        .load()
    )
