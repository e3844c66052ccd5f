"""The 33 data tests of the Gold layer."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallylake.contracts import (
    ACCOUNT_STATUSES, ACCOUNT_TYPES, CURRENCIES, PARTNER_STATUSES, PARTNER_TYPES,
)
from tallylake.operators import quality as q
from tallylake.plans import gold

# The declared column tests.
NOT_NULL = {
    "dim_partners": ["partner_id"],
    "dim_accounts": ["account_id", "partner_id", "account_currency"],
    "dim_currencies": ["currency_code"],
    "fct_daily_volume": [
        "transaction_date", "currency_code", "transaction_count", "gross_volume",
    ],
    "fct_partner_net_position": [
        "partner_id", "currency_code", "entry_count", "total_debits", "total_credits",
        "net_position",
    ],
}
UNIQUE = {
    "dim_partners": ["partner_id"],
    "dim_accounts": ["account_id"],
    "dim_currencies": ["currency_code"],
}
ACCEPTED = {
    "dim_partners": {"partner_type": PARTNER_TYPES, "status": PARTNER_STATUSES},
    "dim_accounts": {
        "account_currency": CURRENCIES,
        "account_type": ACCOUNT_TYPES,
        "status": ACCOUNT_STATUSES,
    },
}
# Child table, child column, parent table, parent column.
RELATIONSHIPS = (
    ("dim_accounts", "partner_id", "dim_partners", "partner_id"),
    ("fct_daily_volume", "currency_code", "dim_currencies", "currency_code"),
    ("fct_partner_net_position", "partner_id", "dim_partners", "partner_id"),
    ("fct_partner_net_position", "currency_code", "dim_currencies", "currency_code"),
)
GRAINS = {
    "fct_daily_volume": ["transaction_date", "currency_code"],
    "fct_partner_net_position": ["partner_id", "currency_code"],
}


def relationship_tests(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Violations of each declared relationship, with its name."""
    return [
        q.relationship_violations(tables[child], child_key, tables[parent], parent_key).select(
            F.lit(f"{child}.{child_key}").alias("relationship"),
            F.col("value").cast("string").alias("value"),
            "n_records",
        )
        for child, child_key, parent, parent_key in RELATIONSHIPS
    ]


def test_names() -> list[str]:
    """Names of the 27 tests on columns and the 6 on whole tables."""
    names = [f"not_null:{t}.{c}" for t, columns in NOT_NULL.items() for c in columns]
    names += [f"unique:{t}.{c}" for t, columns in UNIQUE.items() for c in columns]
    names += [f"accepted_values:{t}.{c}" for t, lists in ACCEPTED.items() for c in lists]
    names += [f"relationships:{child}.{key}" for child, key, *_ in RELATIONSHIPS]
    names += [f"unique_grain:{table}" for table in GRAINS]
    return names + [
        "ledger_entries_have_account", "ledger_entries_sum_to_zero",
        "daily_volume_matches_state", "net_position_matches_ledger",
    ]


def observed(table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` with counters of what its column tests count, filled while an action goes over it: no scan of their own."""
    counters = [F.count_if(F.col(c).isNull()).alias(f"not_null:{table}.{c}") for c in NOT_NULL.get(table, [])]
    counters += [
        F.count_if(~F.col(c).isin(*allowed)).alias(f"accepted_values:{table}.{c}") for c, allowed in ACCEPTED.get(table, {}).items()
    ]
    seen = Observation(f"column tests of {table}")
    return df.observe(seen, *counters), seen


def passed_tests(seen: Iterable[Observation]) -> frozenset[str]:
    """The column tests whose counters stayed at zero."""
    return frozenset(test for one in seen for test, count in one.get.items() if count == 0)


def _key_sets(table: str) -> dict[tuple[str, ...], list[str]]:
    """The tests of a table that count rows by key, by the columns of the key."""
    sets: dict[tuple[str, ...], list[str]] = {}
    for column in UNIQUE.get(table, []):
        sets.setdefault((column,), []).append(f"unique:{table}.{column}")
    if table in GRAINS:
        sets.setdefault(tuple(GRAINS[table]), []).append(f"unique_grain:{table}")
    for child, key, *_ in RELATIONSHIPS:
        if child == table:
            sets.setdefault((key,), []).append(f"relationships:{child}.{key}")
    return sets


def key_counts(table: str, df: DataFrame) -> DataFrame:
    """(test, value, n): rows by key for all such tests of a table, by one scan and one exchange of grouping sets.

    Null values of a single column are left out; keys of several columns have no ``value``.
    """
    sets = _key_sets(table)
    columns = list(dict.fromkeys(c for key in sets for c in key))
    counted = df.groupingSets([[F.col(c) for c in key] for key in sets], *columns).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("key_set")
    )
    tests, value, kept = F.lit(None).cast("array<string>"), F.lit(None).cast("string"), F.lit(False)
    for key, names in sets.items():
        # The id has a bit for each column that isn't in the set, the first column's highest.
        own = F.col("key_set") == sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in key)
        tests = F.when(own, F.array(*map(F.lit, names))).otherwise(tests)
        value = F.when(own, F.col(key[0]).cast("string")).otherwise(value) if len(key) == 1 else value
        kept = F.when(own, F.lit(True) if len(key) > 1 else F.col(key[0]).isNotNull()).otherwise(kept)
    return counted.where(kept).select(F.explode(tests).alias("test"), value.alias("value"), "n")


def key_failures(tables: dict[str, DataFrame]) -> DataFrame:
    """Failures of all tests by key: repeated keys, each as one, and the rows of values that the parent lacks.

    All relationships are one join.
    """
    counts = reduce(DataFrame.unionByName, [key_counts(t, tables[t]) for t in dict.fromkeys([*UNIQUE, *GRAINS])])
    parents = reduce(DataFrame.unionByName, [
        tables[parent].select(F.lit(f"relationships:{child}.{key}").alias("test"), F.col(parent_key).cast("string").alias("value"))
        for child, key, parent, parent_key in RELATIONSHIPS
    ]).where("value IS NOT NULL").distinct().withColumn("known", F.lit(True))
    joined = counts.join(parents, ["test", "value"], "left")
    lacking = F.when(F.col("known").isNull(), F.col("n")).otherwise(0)
    failures = F.when(F.col("test").startswith("relationships:"), lacking).otherwise((F.col("n") > 1).cast("bigint"))
    return joined.select("test", failures.cast("bigint").alias("failures")).where("failures > 0")


def gold_quality_report(
    tables: dict[str, DataFrame], staging: dict[str, DataFrame], zone: str = "UTC", passed: frozenset[str] = frozenset()
) -> DataFrame:
    """(test, failures) for all 33 tests. Column tests in ``passed``, as observed while the tables were written, aren't run again."""
    failures = [key_failures(tables)]
    for table, columns in NOT_NULL.items():
        if open_columns := [c for c in columns if f"not_null:{table}.{c}" not in passed]:
            failures.append(q.null_failures(table, tables[table], open_columns))
    domains = {t: {c: v for c, v in lists.items() if f"accepted_values:{t}.{c}" not in passed} for t, lists in ACCEPTED.items()}
    if any(domains.values()):
        failures.append(q.accepted_value_failures({t: lists for t, lists in domains.items() if lists}, tables))
    ledger, positions = staging["stg_ledger_entries"], tables["fct_partner_net_position"]
    # The ledger is summed by account and currency once, for the orphans and for the positions; a NULL account has no match either.
    per_account = gold.account_movements(ledger)
    orphans = per_account.join(tables["dim_accounts"].select("account_id"), "account_id", "left_anti")
    volume = q.volume_recon_mismatches(
        gold.daily_volume(staging["stg_transactions"], zone), tables["fct_daily_volume"]
    )
    position = q.position_recon_mismatches(
        gold.movements_by_currency(per_account), gold.position_rollup(positions)
    )
    failures += [
        q.failing_rows("ledger_entries_have_account", orphans, F.col("entry_count")),
        q.failing_rows("ledger_entries_sum_to_zero", q.unbalanced_transactions(ledger)),
        q.failing_rows("daily_volume_matches_state", volume),
        q.failing_rows("net_position_matches_ledger", position),
    ]
    return q.quality_report(test_names(), failures)
