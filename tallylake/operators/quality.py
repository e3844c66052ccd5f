"""Data tests. Each returns the rows that break it, so an empty result passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, failures) of the columns with NULLs; one pass for all columns."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "failures").where("failures > 0")


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """(value, n_records) of values that occur more than once; NULLs do not count."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def accepted_value_violations(df: DataFrame, domains: dict[str, tuple[str, ...]]) -> DataFrame:
    """(column_name, value, n_records) of values outside their list; NULLs pass.

    One scan for all columns: only bad values leave it, summed before the shuffle.
    """
    checks = F.array(
        *[
            F.when(
                ~F.col(column).isin(*allowed),
                F.struct(F.lit(column).alias("column_name"), F.col(column).alias("value")),
            )
            for column, allowed in domains.items()
        ]
    )
    return (
        df.select(F.inline(F.array_compact(checks)))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row, NULL keys included.

    Keys are reduced to distinct ones before any shuffle, so a key that holds
    much of the child is compared once. The usual result, no orphan key, ends
    the second pass over the child early.
    """
    keys = child.select(F.col(child_key).alias("orphan_key")).distinct()
    parents = parent.select(F.col(parent_key).alias("parent_key"))
    orphans = keys.join(parents, F.col("orphan_key") == F.col("parent_key"), "left_anti")
    return child.join(orphans, F.col(child_key).eqNullSafe(F.col("orphan_key")), "left_semi")


def relationship_violations(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """(value, n_records) of non-null child values that the parent lacks."""
    values = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(parent_key).alias("parent_key"))
    return values.join(parents, F.col("value") == F.col("parent_key"), "left_anti")


def grain_violations(df: DataFrame, grain: list[str]) -> DataFrame:
    """Keys of the grain with more than one row."""
    return df.groupBy(grain).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def unbalanced_transactions(ledger: DataFrame) -> DataFrame:
    """Transactions whose entries do not sum to zero."""
    return (
        ledger.groupBy("transaction_id")
        .agg(F.sum("amount").alias("unbalanced_amount"))
        .where("unbalanced_amount <> 0")
    )


def volume_recon_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Daily volume computed from the state against the stored fact.

    A missing side counts as 0. A NULL key meets no other and shows on both sides.
    """
    grain = ["transaction_date", "currency_code"]
    fact = actual.groupBy(grain).agg(
        F.sum("transaction_count").alias("actual_transaction_count"),
        F.sum("gross_volume").alias("actual_gross_volume"),
    )
    state = expected.select(
        *grain,
        F.col("transaction_count").alias("expected_transaction_count"),
        F.col("gross_volume").alias("expected_gross_volume"),
    )

    def differs(measure: str) -> Column:
        zero = F.lit(0)
        return F.coalesce(F.col(f"expected_{measure}"), zero) != F.coalesce(
            F.col(f"actual_{measure}"), zero
        )

    return state.join(fact, grain, "full_outer").where(
        differs("transaction_count") | differs("gross_volume")
    )


POSITION_MEASURES = ("entry_count", "total_debits", "total_credits", "net_position")


def position_recon_mismatches(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Currencies where the ledger's measures and the fact's differ, NULLs compared as values."""
    key = "currency_code"
    left = expected.select(key, *[F.col(m).alias(f"expected_{m}") for m in POSITION_MEASURES])
    right = actual.select(key, *[F.col(m).alias(f"actual_{m}") for m in POSITION_MEASURES])
    same = reduce(
        Column.__and__,
        [F.col(f"expected_{m}").eqNullSafe(F.col(f"actual_{m}")) for m in POSITION_MEASURES],
    )
    return left.join(right, key, "full_outer").where(~same)


def schema_diff(spark: SparkSession, actual: T.StructType, contract: T.StructType) -> DataFrame:
    """(position, actual, expected) of each difference in name, type, required flag or order."""
    ours, theirs = _signature(actual), _signature(contract)
    rows = [
        (i, ours[i] if i < len(ours) else None, theirs[i] if i < len(theirs) else None)
        for i in range(max(len(ours), len(theirs)))
    ]
    return spark.createDataFrame(
        [row for row in rows if row[1] != row[2]],
        "position BIGINT, actual STRING, expected STRING",
    )


def stored_schema_diff(spark: SparkSession, stored: DataFrame, contract: T.StructType) -> DataFrame:
    """``schema_diff`` of a stored table, and in ``rows`` how many of its rows each difference concerns.

    The schema and the count come from the table's file footers.
    """
    rows = stored.agg(F.count(F.lit(1)).alias("rows"))
    return schema_diff(spark, stored.schema, contract).withColumn("rows", rows.scalar())


def _signature(schema: T.StructType) -> list[str]:
    return [
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' required'}"
        for f in schema.fields
    ]


# --- the report ------------------------------------------------------------------------
# Each part below gives (test, failures) rows of what fails, several per test or none, so
# that one final aggregation serves all tests.

def null_failures(table: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per NULL found; no shuffle of its own."""
    tests = [F.when(F.col(c).isNull(), f"not_null:{table}.{c}") for c in columns]
    found = df.select(F.explode(F.array_compact(F.array(*tests))).alias("test"))
    return found.withColumn("failures", F.lit(1).cast("bigint"))


def accepted_value_failures(
    domains: dict[str, dict[str, tuple[str, ...]]], tables: dict[str, DataFrame]
) -> DataFrame:
    """One row per distinct value outside its list, for all tables together."""
    bad = [
        accepted_value_violations(tables[table], lists).select(
            F.concat(F.lit(f"accepted_values:{table}."), F.col("column_name")).alias("test"),
            F.lit(1).cast("bigint").alias("failures"),
        )
        for table, lists in domains.items()
    ]
    return _union(bad)


def failing_rows(test: str, failing: DataFrame, weight: Column | None = None) -> DataFrame:
    """One row per failing row, counted as 1 or as ``weight``."""
    amount = F.lit(1) if weight is None else weight
    return failing.select(F.lit(test).alias("test"), amount.cast("bigint").alias("failures"))


def quality_report(tests: list[str], failures: list[DataFrame]) -> DataFrame:
    """(test, failures) for every test. The gate is open when all are 0."""
    counted = _union(failures).groupBy("test").agg(F.sum("failures").alias("failures"))
    names = ", ".join(f"('{test}')" for test in tests)
    every = counted.sparkSession.sql(f"SELECT * FROM VALUES {names} AS tests(test)")
    return every.join(counted, "test", "left").select(
        "test", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    )
