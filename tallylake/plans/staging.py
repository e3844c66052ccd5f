"""Staging models: live rows of the current state, without the change columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallylake.contracts import CONTRACTS, DELETED


def staging_live_rows(state: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Named columns of rows that are not deleted. A NULL flag drops the row."""
    kept = columns or [c for c in state.columns if not c.startswith("_cdc_")]
    return state.where(F.col(DELETED) == F.lit(False)).select(kept)


def staging_models(states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``stg_<table>`` for each current-state table."""
    return {
        f"stg_{table}": staging_live_rows(
            df, [f.name for f in CONTRACTS[table].business_fields]
        )
        for table, df in states.items()
    }
