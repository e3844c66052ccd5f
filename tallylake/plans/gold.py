"""Dimensions, facts and analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallylake.functions.clock import business_day


def _select(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in renames.items()])


def dim_accounts(stg_accounts: DataFrame) -> DataFrame:
    """Accounts of any status."""
    return _select(stg_accounts, {
        "account_id": "account_id", "partner_id": "partner_id", "currency": "account_currency",
        "account_type": "account_type", "status": "status",
        "created_at": "created_at", "updated_at": "updated_at",
    })


def dim_partners(stg_partners: DataFrame) -> DataFrame:
    """Partners of any status."""
    return _select(stg_partners, {
        "partner_id": "partner_id", "name": "partner_name", "country": "country_code",
        "partner_type": "partner_type", "status": "status",
        "created_at": "created_at", "updated_at": "updated_at",
    })


def dim_currencies(dim_accounts: DataFrame) -> DataFrame:
    """Each currency some account has."""
    return (
        dim_accounts.where(F.col("account_currency").isNotNull())
        .select(F.col("account_currency").alias("currency_code"))
        .distinct()
    )


def completed_transactions(stg_transactions: DataFrame, zone: str = "UTC") -> DataFrame:
    """Completed transactions with the day of creation in the business zone."""
    return stg_transactions.where(F.col("status") == "completed").select(
        business_day(stg_transactions, "created_at", zone).alias("transaction_date"),
        "transaction_id",
        F.col("currency").alias("currency_code"),
        "amount",
    )


def daily_volume(
    stg_transactions: DataFrame, zone: str = "UTC", unique_keys: bool = False
) -> DataFrame:
    """Count of distinct transactions and gross amount per day and currency.

    ``unique_keys`` says that transaction_id is unique in the input, as it is in
    a current-state table. Then ids need not be shuffled to be counted.
    """
    ids = F.count("transaction_id") if unique_keys else F.count_distinct("transaction_id")
    return (
        completed_transactions(stg_transactions, zone)
        .groupBy("transaction_date", "currency_code")
        .agg(ids.alias("transaction_count"), F.sum("amount").alias("gross_volume"))
    )


def ledger_with_partner(stg_ledger: DataFrame, dim_accounts: DataFrame) -> DataFrame:
    """Each entry with the partner that owns its account; entries of unknown accounts drop out."""
    owners = dim_accounts.select("account_id", "partner_id")
    return stg_ledger.join(owners, "account_id").select(
        "partner_id", F.col("currency").alias("currency_code"), "entry_type", "amount"
    )


def signed_amounts(ledger: DataFrame) -> DataFrame:
    """Debits and credits as positive columns; a credit is stored negative."""
    kind, amount, zero = F.col("entry_type"), F.col("amount"), F.lit(0).cast("decimal(18,4)")
    return ledger.withColumns({
        "debit_amount": F.when(kind == "debit", amount).otherwise(zero),
        "credit_amount": F.when(kind == "credit", (-amount).cast("decimal(18,4)")).otherwise(zero),
    })


def _movements(ledger: DataFrame, keys: list[str]) -> DataFrame:
    return (
        signed_amounts(ledger)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("entry_count"),
            F.sum("debit_amount").alias("total_debits"),
            F.sum("credit_amount").alias("total_credits"),
            (-F.sum("amount")).alias("net_position"),
        )
    )


def _sum_again(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Coarser sums of already summed measures, in their own types."""
    measures = ("entry_count", "total_debits", "total_credits", "net_position")
    return parts.groupBy(*keys).agg(
        *[F.sum(m).cast(parts.schema[m].dataType).alias(m) for m in measures]
    )


def account_movements(stg_ledger: DataFrame) -> DataFrame:
    """Movements per account and currency."""
    return _movements(stg_ledger, ["account_id", "currency"])


def movements_by_currency(per_account: DataFrame) -> DataFrame:
    """Movements per account at the coarser grain of currency."""
    return _sum_again(per_account.withColumnRenamed("currency", "currency_code"), ["currency_code"])


def partner_net_position(stg_ledger: DataFrame, dim_accounts: DataFrame) -> DataFrame:
    """Movements per partner and currency: credits less debits, without an opening balance.

    Entries are summed per account before the join, so an account that holds
    much of the ledger meets its owner as one row per currency.
    """
    per_account = account_movements(stg_ledger)
    owners = dim_accounts.select("account_id", "partner_id")
    owned = per_account.join(owners, "account_id").withColumnRenamed("currency", "currency_code")
    return _sum_again(owned, ["partner_id", "currency_code"])


def position_rollup(positions: DataFrame) -> DataFrame:
    """The position fact at the coarser grain of currency."""
    return _sum_again(positions, ["currency_code"])


def ledger_by_currency(stg_ledger: DataFrame) -> DataFrame:
    """The same measures straight from the ledger."""
    return _movements(stg_ledger, ["currency"]).withColumnRenamed("currency", "currency_code")


def position_with_partner(positions: DataFrame, dim_partners: DataFrame) -> DataFrame:
    """Each position with its partner's name."""
    return positions.join(dim_partners.select("partner_id", "partner_name"), "partner_id")


def top_positions(positions: DataFrame, dim_partners: DataFrame, size: int = 3) -> DataFrame:
    """The greatest positive positions of each currency; ties go to the lower partner id."""
    order = Window.partitionBy("currency_code").orderBy(F.desc("net_position"), "partner_id")
    return (
        position_with_partner(positions.where("net_position > 0"), dim_partners)
        .withColumn("position_ranking", F.row_number().over(order))
        .where(F.col("position_ranking") <= size)
        .select(
            "currency_code", "partner_name", "total_debits", "total_credits", "net_position",
            "position_ranking",
        )
        .orderBy("currency_code", "position_ranking")
    )


def build_gold(staging: dict[str, DataFrame], zone: str = "UTC") -> dict[str, DataFrame]:
    """The five Gold models over staging models of current-state tables."""
    accounts = dim_accounts(staging["stg_accounts"])
    return {
        "dim_accounts": accounts,
        "dim_partners": dim_partners(staging["stg_partners"]),
        "dim_currencies": dim_currencies(accounts),
        "fct_daily_volume": daily_volume(staging["stg_transactions"], zone, unique_keys=True),
        "fct_partner_net_position": partner_net_position(staging["stg_ledger_entries"], accounts),
    }
