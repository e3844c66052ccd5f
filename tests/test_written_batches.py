"""Batches of the upsert queries are parsed once: what is applied comes from written tables."""

import pytest

from tallylake.checks import QUERIES
from tallylake.sources.tables import SilverTable

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "batches"), [("upsert_latest_state", 3), ("replay_idempotent", 5)])
def test_applied_batches_are_written(spark, monkeypatch, name, batches):
    read, apply = [], SilverTable.apply
    monkeypatch.setattr(SilverTable, "apply", lambda self, batch: read.append(batch.inputFiles()) or apply(self, batch))
    assert QUERIES[name](spark, SF).count()
    assert len(read) == batches
    assert all(files and all(f.endswith(".parquet") for f in files) for files in read)
