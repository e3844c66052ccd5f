"""The queries of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


ROOT = str(Path(__file__).resolve().parents[2])


def let_workers_import(spark: SparkSession) -> None:
    """Python workers on this machine find the package where the driver found it; a cluster has it installed."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            let_workers_import(spark)
            return function(spark, sf_dir.rstrip("/"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register
