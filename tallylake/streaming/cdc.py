"""Change events applied to a current-state table as a stream of micro-batches."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallylake.operators.envelope import stage_events
from tallylake.operators.latest import latest_by_lsn
from tallylake.sources.tables import SilverTable, VersionedTable

APPLIED_SCHEMA = "stream STRING, batch_id BIGINT"


def apply_cdc_stream(
    lines: DataFrame, table: SilverTable, checkpoint: str, staging: str, **trigger: object
) -> StreamingQuery:
    """Validate, reduce and upsert each micro-batch of raw lines.

    Progress per file is the stream's checkpoint; order per row is the LSN. Which batch was applied
    last is recorded in ``staging`` with the stream's id, which its checkpoint keeps: a batch that comes
    again after a restart is not even read, and one that was interrupted before its record is repeated,
    where the LSN rule ignores what is there already. A batch's staged folder goes once it is recorded.
    The result does not depend on how the input is split. A broken batch stops the stream.
    """
    contract, root = table.contract, staging.rstrip("/")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target, done = SilverTable(spark, table.path, contract), VersionedTable(spark, f"{root}/applied")
        stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first().value)["id"]
        last = done.read().where(f"stream = '{stream}'").first() if done.exists() else None
        path = f"{root}/batch={batch_id}"
        if last is None or batch_id > last.batch_id:
            staged = stage_events(batch, contract, f"{path}/events")
            latest = latest_by_lsn(staged.select(contract.columns), contract.primary_key)
            latest.write.mode("overwrite").parquet(f"{path}/latest")
            target.apply(spark.read.schema(contract.schema).parquet(f"{path}/latest"))
            target.compact()
            done.replace(spark.createDataFrame([(stream, batch_id)], APPLIED_SCHEMA).coalesce(1))
            done.vacuum()
        fs, folder = done._file_system(path)
        fs.delete(folder, True)

    return (
        lines.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
