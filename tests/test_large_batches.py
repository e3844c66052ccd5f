"""Batches whose whole rows stay where they are: newest versions, upserts and folds by keys alone."""

import random
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallylake.contracts import CONTRACTS
from tallylake.operators import latest as newest
from tallylake.operators.envelope import extract_envelope
from tallylake.sources.tables import SilverTable

LEDGER = CONTRACTS["ledger_entries"]
OPENING = datetime(2033, 8, 9, 1, 15, tzinfo=timezone.utc)


def entry(key, cents, lsn, deleted=False):
    return (key, "tx-4", "acc-8", "debit", Decimal(cents) / 100, "EUR", None, OPENING, lsn, deleted)


def written(spark, path, rows, schema=LEDGER.schema):
    spark.createDataFrame(rows, schema).write.parquet(str(path))
    return spark.read.parquet(str(path))


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("few", [0, 1 << 22])
def test_newest_versions_beside_repeated_keys(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(newest, "FEW_KEYS", few)
    rng = random.Random(5)
    schema = "entry_id STRING, amount INT, _cdc_lsn BIGINT, note STRING"
    # Keys, LSNs and whole rows repeat, and each of them may be null.
    rows = [(rng.choice(["a", "b", None, *[f"k{n}"] * 3]), rng.choice([1, 2, None]), rng.choice([1, 2, None]), rng.choice(["x", None])) for n in range(60)]
    events = written(spark, tmp_path / "events", rows, schema)
    found = newest.latest_of_written(events, "entry_id", str(tmp_path / "repeated"))
    assert bag(found) == bag(newest.latest_by_lsn(events, "entry_id"))


def test_events_of_different_keys_are_their_newest_versions(spark, tmp_path):
    events = written(spark, tmp_path / "events", [entry(f"e{n}", n, n) for n in range(9)])
    assert newest.latest_of_written(events, "entry_id", str(tmp_path / "repeated")) is events


class Table(SilverTable):
    """Every batch is a large one."""

    SMALL_BATCH = 0


@pytest.mark.parametrize("few, fold", [(0, True), (3, True), (500_000, False)])
def test_large_batches_give_the_state_of_small_ones(spark, tmp_path, monkeypatch, few, fold):
    monkeypatch.setattr(Table, "FEW_KEYS", few)
    large, small = Table(spark, str(tmp_path / "large"), LEDGER), SilverTable(spark, str(tmp_path / "small"), LEDGER)
    rng = random.Random(6)
    for step, size in enumerate((6, 11, 9)):
        keys = rng.sample(range(12), size)
        batch = written(spark, tmp_path / f"batch{step}", [entry(f"e{k}", rng.randrange(900), rng.randrange(30), rng.random() < 0.3) for k in keys])
        assert large.apply(batch, fold=fold) == small.apply(batch)
        assert bag(large.read()) == bag(small.read())
    assert not [p for p in (tmp_path / "large").iterdir() if p.name.startswith("_work")]


def test_a_batch_that_is_due_to_be_folded_is_written_once(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), LEDGER)
    table.apply(written(spark, tmp_path / "one", [entry(f"e{n}", 1, 1) for n in range(8)]), fold=True)
    stale = [entry("e7", 5, 1), entry("e6", 5, 1)]
    assert table.apply(written(spark, tmp_path / "two", [*[entry(f"e{n}", 2, 2) for n in range(5)], *stale]), fold=True) == (5, 2)
    assert [kind for _, kind, _ in table.published()] == ["state", "state"] and not table.compact()
    assert [r.n for r in table.read().groupBy("_cdc_lsn").agg(F.count("*").alias("n")).orderBy("_cdc_lsn").collect()] == [3, 5]
    assert table.apply(written(spark, tmp_path / "three", [entry("e1", 9, 3)]), fold=True) == (1, 0)
    assert table.published()[-1][1] == "changes"


def test_near_holds_the_rows_of_the_batch(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), LEDGER)
    table.apply(written(spark, tmp_path / "one", [entry(f"e{n}", 1, 1) for n in range(40)]))
    for name, keys in (("few", ["e1"]), ("many", ["e1", "e2", "e3", "e4", "e9"])):
        batch = written(spark, tmp_path / name, [entry(k, 2, 2) for k in keys])
        assert set(keys) <= {r.entry_id for r in table.near(batch, ["_cdc_lsn"]).collect()}


def test_a_line_is_shaped_without_a_variant_of_its_own(spark):
    lines = spark.createDataFrame([('{"op":"c","source":{"lsn":3},"after":{"entry_id":"e"}}',), ('{"op":"c"} 1',), ('["c"]',)], "value STRING")
    envelope = extract_envelope(lines, LEDGER)
    assert [(r.well_formed, r.lsn, r.after.entry_id if r.after else None) for r in envelope.collect()] == [(True, "3", "e"), (False, None, None), (False, None, None)]
    # The list's mark and its first item; once more would be an item taken out of a variant of its own.
    assert envelope._jdf.queryExecution().analyzed().toString().count("variant_get(") == 2
