"""Observations without the repeats that republishing causes."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

# Settings for state larger than memory, of which a batch uploads only its changes.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_large_state(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB. A stream stays with the store it began with."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


def dedup_observation_stream(
    events: DataFrame, event_time: str = "ingested_time", delay: str = "1 day"
) -> DataFrame:
    """Drop repeats of an ``event_id`` that arrive within ``delay`` of each other.

    The state of an id is kept for that delay only, so it does not grow forever. A row that is later than
    the delay can't be judged any more and is dropped; ``LateRows`` counts those.
    """
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["event_id"])


class LateRows(StreamingQueryListener):
    """Rows that streams dropped as too late, and the rows of state they hold, by query run."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = defaultdict(int)
        self.state_rows: dict[str, list[int]] = defaultdict(list)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        for operator in event.progress.stateOperators:
            self.dropped[run] += operator.numRowsDroppedByWatermark
            self.state_rows[run].append(operator.numRowsTotal)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
