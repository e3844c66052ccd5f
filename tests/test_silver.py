import itertools
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallylake.contracts import CONTRACTS
from tallylake.operators.latest import latest_by_lsn
from tallylake.sources.tables import SchemaMismatch, SilverTable, VersionedTable, merge_into_catalog

LEDGER = CONTRACTS["ledger_entries"]
OPENING = datetime(2031, 3, 2, 6, 45, tzinfo=timezone.utc)


def entry(key, cents, lsn, deleted=False, created=OPENING):
    return (key, "tx-7", "acc-3", "credit", Decimal(cents) / 100, "CHF", "fee", created, lsn, deleted)


def batch(spark, *entries):
    return spark.createDataFrame(list(entries), LEDGER.schema)


def state(table):
    columns = ["entry_id", "amount", "_cdc_lsn", "_cdc_deleted"]
    return {r[0]: tuple(r)[1:] for r in table.read(columns).collect()}


@pytest.fixture
def table(spark, tmp_path):
    return SilverTable(spark, str(tmp_path / "ledger"), LEDGER)


class Model:
    """What the table has to do, as a dictionary: only a strictly greater LSN replaces a row, a deletion too."""

    def __init__(self):
        self.rows = {}

    def apply(self, entries):
        newest = {}
        for e in sorted(entries, key=lambda e: e[8]):
            newest[e[0]] = e
        taken = [e for e in newest.values() if e[0] not in self.rows or e[8] > self.rows[e[0]][1]]
        self.rows |= {e[0]: (e[4], e[8], e[9]) for e in taken}
        return len(taken), len(newest) - len(taken)


@pytest.mark.parametrize("seed", [21, 22])
def test_random_batches_replays_and_late_events(spark, tmp_path, seed):
    rng, model, table = random.Random(seed), Model(), SilverTable(spark, str(tmp_path / "t"), LEDGER)
    pool = [entry(f"e{rng.randrange(5)}", rng.randrange(1, 900), lsn, rng.random() < 0.3) for lsn in rng.sample(range(500), 30)]
    for step in range(6):
        # Anything may come again, and in any order.
        some = rng.choices(pool, k=rng.randrange(1, 8))
        assert table.apply(latest_by_lsn(batch(spark, *some), "entry_id")) == model.apply(some)
        if step % 3 == 2:
            table.compact(force=True)
        assert state(table) == model.rows
    live = {k for k, (_, _, deleted) in model.rows.items() if not deleted}
    assert {r.entry_id for r in table.read(["entry_id"], live_only=True).collect()} == live


def test_an_equal_lsn_is_no_newer_one(spark, table):
    assert table.apply(batch(spark, entry("e", 100, 8))) == (1, 0)
    before = table.published()
    assert table.apply(batch(spark, entry("e", 300, 8))) == (0, 1) and table.apply(batch(spark)) == (0, 0)
    assert table.published() == before


def test_a_table_without_events_is_empty(spark, table):
    assert table.apply(batch(spark)) == (0, 0) and not table.exists()
    assert table.read().schema.names == LEDGER.columns and table.read(["amount"], live_only=True).count() == 0


def test_any_split_and_order_gives_the_same_state(spark, tmp_path):
    rng = random.Random(7)
    keys = [f"k{n}" for n in range(6)]
    events = [entry(rng.choice(keys), n * 100, n, rng.random() < 0.2) for n in range(1, 41)]
    expected = None
    for round_ in range(3):
        rng.shuffle(events)
        cuts = sorted(rng.sample(range(1, 40), round_ + 1))
        table = SilverTable(spark, str(tmp_path / f"t{round_}"), LEDGER)
        for low, high in itertools.pairwise([0, *cuts, 40]):
            table.apply(latest_by_lsn(batch(spark, *events[low:high]), "entry_id"))
            table.compact()
        expected = expected or state(table)
        assert state(table) == expected


def test_a_tombstone_replaces_a_row_of_a_dated_partition(spark, table):
    table.apply(batch(spark, entry("e", 100, 1)))
    table.apply(batch(spark, ("e", *[None] * 7, 2, True)))
    assert state(table) == {"e": (None, 2, True)}
    table.compact(force=True)
    assert state(table) == {"e": (None, 2, True)}


def test_a_write_that_is_not_published_is_invisible(spark, table):
    table.apply(batch(spark, entry("e", 100, 1)))
    lost = table.write_state(batch(spark, entry("f", 900, 9)), "created_at")
    assert lost.rows == 1 and set(state(table)) == {"e"}
    # The next write takes the same number, in a folder of its own.
    assert table.next_version() == lost.version
    table.apply(batch(spark, entry("e", 200, 2)))
    assert state(table) == {"e": (Decimal(2), 2, False)} and table.read_write(lost).count() == 1


def test_of_two_writers_the_second_fails_and_breaks_nothing(spark, table):
    other = SilverTable(spark, table.path, LEDGER)
    one = table.write_state(batch(spark, entry("e", 100, 1)), "created_at")
    two = other.write_state(batch(spark, entry("f", 200, 2)), "created_at")
    table.publish(one)
    for again in (two, one):
        with pytest.raises(RuntimeError):
            other.publish(again)
    assert set(state(table)) == {"e"} and table.published() == [(1, "state", 1)]


def test_compaction_is_due_by_share_or_number(spark, table):
    table.apply(batch(spark, *[entry(f"k{n}", 100, 1) for n in range(100)]))
    table.apply(batch(spark, entry("k1", 200, 2)))
    assert not table.compact()
    table.apply(batch(spark, *[entry(f"k{n}", 300, 3) for n in range(30)]))
    before = state(table)
    assert table.compact() and state(table) == before
    assert [kind for _, kind, _ in table.published()][-1] == "state"


def test_old_states_are_removed_and_the_current_one_stays(spark, table, tmp_path):
    for lsn in range(1, 6):
        table.apply(batch(spark, entry("e", 100 * lsn, lsn)))
        table.compact(force=True)
    before, folders = state(table), sum(p.is_dir() and p.name[0] == "0" for p in (tmp_path / "ledger").iterdir())
    assert table.vacuum(keep=1) == folders - 1 and state(table) == before
    assert [kind for _, kind, _ in table.published()] == ["state"] and table.vacuum(keep=1) == 0
    assert table.apply(batch(spark, entry("e", 900, 6))) == (1, 0)


@pytest.mark.parametrize("change", [
    lambda df: df.withColumnRenamed("entry_type", "kind"),
    lambda df: df.drop("currency"),
    lambda df: df.withColumn("amount", F.col("amount").cast("double")),
    lambda df: df.withColumn("note", F.lit("x")),
])
def test_a_table_that_differs_from_its_contract_is_refused(spark, table, change):
    table.publish(VersionedTable(spark, table.path).write_state(change(batch(spark, entry("e", 100, 1)))))
    for use in (lambda: table.read(), lambda: table.apply(batch(spark, entry("e", 200, 2))), lambda: table.compact(force=True) or table.read()):
        with pytest.raises(SchemaMismatch, match="ledger_entries"):
            use()
    assert len(table.published()) == 1


def test_columns_filters_and_days_reach_the_scan(spark, table):
    days = [OPENING + timedelta(days=d) for d in range(3)]
    table.apply(batch(spark, *[entry(f"k{d.day}", 100, 1, False, d) for d in days]))
    table.apply(batch(spark, entry("k3", 200, 2, False, days[1]), entry("k9", 100, 1, False, days[1])))
    found = table.read(["entry_id"], live_only=True, days=("2031-03-03", "2031-03-03"))
    assert sorted(r.entry_id for r in found.collect()) == ["k3", "k9"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_cdc_deleted), Not(EqualTo(_cdc_deleted,true))" in plan
    assert "PartitionFilters: [isnotnull(created_at_day" in plan
    plain = table.read(["entry_id", "_cdc_lsn"])._jdf.queryExecution().executedPlan().toString()
    assert "currency" not in plain and "hashpartitioning" not in plain


def test_a_small_batch_does_not_shuffle_the_table(spark, table, tmp_path):
    table.apply(batch(spark, *[entry(f"k{n}", 100, 1) for n in range(50)]))
    batch(spark, entry("k1", 200, 2)).write.parquet(str(tmp_path / "batch"))
    written = spark.read.parquet(str(tmp_path / "batch"))
    found = table.lookup(written, ["_cdc_lsn"])
    assert [r._cdc_lsn for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_full_rebuild_replaces_the_last_version(spark, tmp_path):
    gold = VersionedTable(spark, str(tmp_path / "gold"))
    with pytest.raises(FileNotFoundError):
        gold.read()
    assert gold.replace(spark.range(3)) == 3
    old = gold.read()
    assert gold.replace(gold.read().where("id > 0")) == 2
    assert gold.read().count() == 2 and old.count() == 3


def test_moving_never_overwrites(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path / name)) for name in ("one", "two"))
    one.replace(spark.range(2))
    two.replace(spark.range(1))
    with pytest.raises(FileExistsError):
        one.move(two.path)
    moved = one.move(str(tmp_path / "legacy" / "one"))
    assert moved.read().count() == 2 and not one.exists()


def test_merge_needs_a_catalog_that_supports_it(spark, tmp_path):
    # There is no such catalog here; the builder must at least resolve its columns.
    spark.sql(f"CREATE TABLE plain (id BIGINT, _cdc_lsn BIGINT) USING parquet LOCATION '{tmp_path}/p'")
    rows = spark.range(1).withColumn("_cdc_lsn", F.lit(1).cast("bigint"))
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into_catalog(rows, "plain", "id")
    spark.sql("DROP TABLE plain")
