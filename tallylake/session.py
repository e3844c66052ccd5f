"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Days, epoch texts and partitions are defined in UTC, so every session uses it.
SESSION_ZONE = "UTC"

#: How Parquet is written: keys are texts of hex digits, which zstd halves and snappy leaves as they are.
COMPACT = {"compression": "zstd"}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_bases: dict[str, str] = {}


def build_session(app: str = "tallylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect. Cluster sizing stays with spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", SESSION_ZONE)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Silver and Gold files aim at 128 MiB.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "134217728")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a statement's shuffle files go when it ends, and not when the driver happens to collect garbage.

    A DataFrame that is run twice makes its shuffles again.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def workspace(spark: SparkSession, *parts: str) -> str:
    """A folder for written intermediate tables, on storage all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go
    without: there the driver's disk is also the executors' disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    application = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        if application not in _local_bases:
            _local_bases[application] = tempfile.mkdtemp(prefix="tallylake-")
        base = _local_bases[application]
    return "/".join([base.rstrip("/"), f"tallylake-{application}", *parts])


def new_run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the workspace; never reused, so a retry cannot read old files."""
    return workspace(spark, name, uuid.uuid4().hex)
