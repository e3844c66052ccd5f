"""The finance tables derived from the given tables, clean and with seeded faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.contracts import DELETED, LSN, MONEY


_tables: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the file once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables or _tables[key].sparkSession is not spark:
        _tables[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _tables[key]


def _no_time() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.cast("bigint").alias("partner_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("country"),
        F.when(key % 3 == 0, "merchant").when(key % 3 == 1, "bank").otherwise("processor").alias(
            "partner_type"
        ),
        F.when(key % 10 == 9, "suspended").otherwise("active").alias("status"),
        _no_time().alias("created_at"),
        _no_time().alias("updated_at"),
        F.lit(False).alias(DELETED),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        key.alias("account_id"),
        F.col("c_nationkey").cast("bigint").alias("partner_id"),
        F.when(segment == "FURNITURE", "USD")
        .when(segment == "MACHINERY", "BRL")
        .when(segment == "BUILDING", "EUR")
        .when(segment == "AUTOMOBILE", "GBP")
        .otherwise("JPY")
        .alias("currency"),
        F.when(key % 3 == 0, "settlement").when(key % 3 == 1, "holding").otherwise("fee").alias(
            "account_type"
        ),
        F.when(F.col("c_acctbal") < 0, "frozen").otherwise("active").alias("status"),
        _no_time().alias("created_at"),
        _no_time().alias("updated_at"),
        F.lit(False).alias(DELETED),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    customers = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("n")).scalar()
    owner = accounts(spark, sf_dir).select("account_id", "currency")
    return orders.join(owner, F.col("o_custkey") == F.col("account_id")).select(
        key.alias("transaction_id"),
        F.col("o_custkey").alias("source_account_id"),
        ((F.col("o_custkey") * 7 + 13) % customers).alias("destination_account_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        "currency",
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("authorized")
        .alias("status"),
        F.col("o_orderdate").alias("created_at"),
        key.alias(LSN),
        (key % 50 == 0).alias(DELETED),
    )


def ledger_entries(spark: SparkSession, sf_dir: str, posted: DataFrame | None = None) -> DataFrame:
    """Two entries for each transaction, of ``posted`` if given."""
    side = F.array(
        F.struct(F.lit(0).alias("n"), F.lit("debit").alias("entry_type"),
                 F.col("source_account_id").alias("account_id"), F.col("amount").alias("value")),
        F.struct(F.lit(1).alias("n"), F.lit("credit").alias("entry_type"),
                 F.col("destination_account_id").alias("account_id"),
                 (-F.col("amount")).cast(MONEY).alias("value")),
    )
    rows = transactions(spark, sf_dir) if posted is None else posted
    return rows.select("*", F.explode(side).alias("side")).select(
        (F.col("transaction_id") * 2 + F.col("side.n")).alias("entry_id"),
        "transaction_id",
        "side.account_id",
        "side.entry_type",
        F.col("side.value").alias("amount"),
        "currency",
        "created_at",
        LSN,
        DELETED,
    )


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("transaction_id"),
        "event_type",
        F.col("props").alias("metadata"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias(LSN),
        F.when(kind == "signup", "c").when(kind == "error", "d").otherwise("u").alias("op"),
        (kind == "error").alias(DELETED),
    )


# --- seeded faults: the rows stay, some values change ----------------------------------

def _fault(column: str, key: str, every: int, value: Column) -> Column:
    return F.when(F.col(key) % every == 0, value).otherwise(F.col(column))


def faulted_partners(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "partner_id"
    return partners(spark, sf_dir).withColumn(
        "partner_type", _fault("partner_type", key, 11, F.lit("broker"))
    )


def faulted_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, null = "account_id", F.lit(None)
    df = accounts(spark, sf_dir)
    df = df.withColumn("currency", _fault("currency", key, 101, F.lit("XXX")))
    df = df.withColumn("currency", _fault("currency", key, 103, null))
    df = df.withColumn("partner_id", _fault("partner_id", key, 107, F.col("partner_id") + 1000))
    df = df.withColumn("partner_id", _fault("partner_id", key, 109, null))
    df = df.withColumn("account_type", _fault("account_type", key, 113, F.lit("escrow")))
    return df.withColumn("status", _fault("status", key, 127, F.lit("dormant")))


def faulted_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "transaction_id"
    df = transactions(spark, sf_dir)
    df = df.withColumn("amount", _fault("amount", key, 97, (F.col("amount") + 1).cast(MONEY)))
    return df.withColumn("currency", _fault("currency", key, 1009, F.lit(None)))


def faulted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = "entry_id"
    df = ledger_entries(spark, sf_dir)
    df = df.withColumn("account_id", _fault("account_id", key, 89, F.col("account_id") + 1000000))
    return df.withColumn("amount", _fault("amount", key, 97, (F.col("amount") + 1).cast(MONEY)))


def events_of_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """LSNs of the events of all five tables; partners and accounts, which have none here, get them from their keys."""
    made = {
        "transactions": transactions(spark, sf_dir), "ledger_entries": ledger_entries(spark, sf_dir),
        "payment_events": payment_events(spark, sf_dir),
        "accounts": accounts(spark, sf_dir).withColumn(LSN, F.col("account_id") * 3),
        "partners": partners(spark, sf_dir).withColumn(LSN, F.col("partner_id") * 5),
    }
    return {name: df.select(LSN) for name, df in made.items()}
