import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallylake.operators.envelope import ContractError
from tallylake.plans.jobs import apply_table, reconcile_lake
from tallylake.plans.pipeline import CHECKPOINT_SCHEMA, GateError, Lake, commit_checkpoint, run_landed_microbatch, run_microbatch
from tallylake.sources.bronze import open_day_folders
from tallylake.streaming.landing import land_cdc_stream


def uuid(number):
    return f"{number:08d}-0000-0000-0000-000000000000"


def image(table, number, **values):
    base = {"created_at": "2029-02-11T17:35:00Z", "updated_at": "2029-02-12T08:00:00Z"}
    rows = {
        "partners": {"partner_id": uuid(1), "name": "P", "country": "BR",
                     "partner_type": "bank", "status": "active"},
        "accounts": {"account_id": uuid(number), "partner_id": uuid(1), "currency": "BRL",
                     "account_type": "settlement", "status": "active"},
        "transactions": {"transaction_id": uuid(number), "source_account_id": uuid(1),
                         "destination_account_id": uuid(2), "amount": "10.0000", "currency": "BRL",
                         "status": "completed", "payment_method": "pix"},
        "payment_events": {"event_id": uuid(number), "transaction_id": uuid(number),
                           "event_type": "initiated", "metadata": "{}"},
        "ledger_entries": {"entry_id": uuid(number), "transaction_id": uuid(1),
                           "account_id": uuid(1), "entry_type": "debit", "amount": "10.0000",
                           "currency": "BRL"},
    }
    return {**base, **rows[table], **values}


def land(bronze, table, offset, *events, day="2029-02-11"):
    topic = f"cdc.public.{table}"
    year, month, number = day.split("-")
    folder = bronze / "topics" / topic / f"year={year}" / f"month={month}" / f"day={number}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({"op": op, "source": {"lsn": lsn}, "before": None, "after": after})
        for lsn, op, after in events
    ]
    (folder / f"{topic}+0+{offset:010d}.json").write_text("\n".join(lines) + "\n")


def land_all(bronze):
    land(bronze, "partners", 0, (1, "r", image("partners", 1)))
    land(bronze, "accounts", 0, (2, "r", image("accounts", 1)), (3, "r", image("accounts", 2)))
    land(bronze, "transactions", 0, (4, "c", image("transactions", 1)))
    land(bronze, "payment_events", 0, (5, "c", image("payment_events", 1)))
    land(bronze, "ledger_entries", 0, (6, "c", image("ledger_entries", 1)), (
        7, "c", image("ledger_entries", 2, account_id=uuid(2), entry_type="credit", amount="-10.0000")
    ))
    land(bronze, "unknown_table", 4, (8, "c", {"id": 1}))


@pytest.fixture
def lake(spark, tmp_path):
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    return Lake(spark, str(tmp_path / "lake")), bronze


def offsets(lake):
    return {(r.topic, r.last_offset) for r in lake.read_checkpoint().collect()}


def test_a_first_run_without_files_does_nothing(spark, lake):
    lake, bronze = lake
    (bronze / "topics").mkdir()
    assert not run_microbatch(spark, str(bronze), lake).committed
    assert not lake.checkpoint.exists()


def test_batches_failures_and_repeats(spark, lake):
    lake, bronze = lake
    land_all(bronze)
    first = run_microbatch(spark, str(bronze), lake)
    assert first.committed and first.cutoff_lsn == 7
    assert first.applied["ledger_entries"] == (2, 0) and "unknown_table" not in first.applied
    assert ("cdc.public.unknown_table", 4) in offsets(lake)
    position, = lake.gold("fct_partner_net_position").read().collect()
    assert (position.entry_count, position.total_debits, position.net_position) == (2, 10, 0)
    volume, = lake.gold("fct_daily_volume").read().collect()
    assert (volume.transaction_count, volume.gross_volume) == (1, Decimal("10.0000"))

    # Nothing new: nothing happens.
    assert not run_microbatch(spark, str(bronze), lake).committed

    # A broken event stops the run before anything is applied.
    before = offsets(lake), lake.silver("accounts").published()
    land(bronze, "accounts", 50, (20, "u", image("accounts", 1, status="frozen")), (21, "x", {}))
    with pytest.raises(ContractError, match="unsupported_op: 1"):
        run_microbatch(spark, str(bronze), lake)
    assert (offsets(lake), lake.silver("accounts").published()) == before

    # The corrected file is applied by the next run.
    land(bronze, "accounts", 50, (20, "u", image("accounts", 1, status="frozen")))
    second = run_microbatch(spark, str(bronze), lake)
    assert second.applied == {"accounts": (1, 0)} and second.cutoff_lsn == 20
    assert {r.status for r in lake.gold("dim_accounts").read().collect()} == {"active", "frozen"}

    # A ledger that does not balance stops Gold and the checkpoint, on every repeat.
    versions, before = lake.releases.published(), offsets(lake)
    land(bronze, "ledger_entries", 60, (30, "c", image("ledger_entries", 3)))
    for _ in range(2):
        with pytest.raises(GateError, match="ledger_total"):
            run_microbatch(spark, str(bronze), lake)
    assert lake.releases.published() == versions and offsets(lake) == before

    # Its counter-entry sums to zero but has no account: a data test stops it.
    orphan = image("ledger_entries", 4, account_id=uuid(9), entry_type="credit", amount="-10.0000")
    land(bronze, "ledger_entries", 70, (31, "c", orphan))
    with pytest.raises(GateError, match="ledger_entries_have_account=1"):
        run_microbatch(spark, str(bronze), lake)
    assert offsets(lake) == before

    # Repaired by a later version; the repeated entries are ignored.
    land(bronze, "ledger_entries", 80, (40, "u", {**orphan, "account_id": uuid(2)}))
    third = run_microbatch(spark, str(bronze), lake)
    assert third.committed and third.applied["ledger_entries"] == (1, 1)
    assert lake.read_checkpoint().first().lsn == 40

    with pytest.raises(ValueError, match="may not go back"):
        commit_checkpoint(lake, 39, lake.read_checkpoint().drop("lsn"))


def test_a_second_event_on_a_line_stops_the_batch(spark, lake):
    lake, bronze = lake
    land_all(bronze)
    assert run_microbatch(spark, str(bronze), lake).committed
    before = offsets(lake), lake.silver("accounts").published()
    lines = [json.dumps({"op": "u", "source": {"lsn": lsn}, "before": None, "after": image("accounts", n)}) for lsn, n in ((50, 1), (51, 2))]
    folder = bronze / "topics" / "cdc.public.accounts" / "year=2029" / "month=02" / "day=11"
    (folder / "cdc.public.accounts+0+0000000090.json").write_text("".join(lines) + "\n")
    with pytest.raises(ContractError, match="malformed_json: 1"):
        run_microbatch(spark, str(bronze), lake)
    assert (offsets(lake), lake.silver("accounts").published()) == before


def test_a_first_batch_may_lack_tables(spark, lake, tmp_path):
    lake, bronze = lake
    land(bronze, "unknown_table", 4, (8, "c", {"id": 1}))
    with pytest.raises(GateError, match="no earlier one"):
        run_microbatch(spark, str(bronze), lake)
    assert not lake.checkpoint.exists()
    land(bronze, "partners", 0, (1, "r", image("partners", 1)))
    assert run_microbatch(spark, str(bronze), lake).applied == {"partners": (1, 0)}
    assert lake.gold("dim_partners").read().count() == 1 and lake.gold("fct_daily_volume").read().count() == 0
    # The run's own tables are gone.
    assert not any((tmp_path / "lake" / "_work").iterdir())


def test_one_table_is_applied_and_the_lake_reconciled(spark, lake):
    lake, bronze = lake
    land_all(bronze)
    assert apply_table(lake, str(bronze), "ledger_entries", max_lsn=6) == (1, 0)
    assert apply_table(lake, str(bronze), "ledger_entries", date="2029-02-11") == (1, 1)
    assert apply_table(lake, str(bronze), "ledger_entries", date="2029-02-12") == (0, 0)
    assert not lake.checkpoint.exists()
    assert run_microbatch(spark, str(bronze), lake).committed
    assert all(r.in_sync for r in reconcile_lake(lake, str(bronze)).collect())
    land(bronze, "accounts", 9, (99, "r", image("accounts", 3)))
    found = {r.item: r.in_sync for r in reconcile_lake(lake, str(bronze)).collect()}
    assert not found["rows:accounts"] and found["rows:partners"]
    assert all(r.in_sync for r in reconcile_lake(lake, str(bronze), cutoff=7).collect())
    source = {name: lake.silver(name).read() for name in lake.contracts}
    assert {r.item for r in reconcile_lake(lake, str(bronze), source).collect() if not r.in_sync} == {"rows:accounts"}


def test_a_batch_lists_open_days_only(spark, lake):
    """Ten old days of history: later batches list none of them, unless told to."""
    lake, bronze = lake
    for day in range(1, 11):
        land(bronze, "partners", day, (day, "r", image("partners", 1, name=f"P{day}")), day=f"2029-01-{day:02d}")
    land(bronze, "partners", 50, (50, "r", image("partners", 1, name="P50")), day="2029-02-11")
    assert run_microbatch(spark, str(bronze), lake).cutoff_lsn == 50
    assert {str(r.last_day) for r in lake.read_checkpoint().collect()} == {"2029-02-11"}

    since = {"cdc.public.partners": lake.read_checkpoint().first().last_day}
    listed = open_day_folders(spark, str(bronze), since)
    assert len(listed) == 1 and listed[0].endswith("year=2029/month=02/day=11")
    assert len(open_day_folders(spark, str(bronze), {})) == 11

    # A new topic is listed from its beginning, an old one from its open days on.
    land(bronze, "accounts", 0, (60, "r", image("accounts", 1)), day="2029-01-03")
    land(bronze, "partners", 70, (70, "u", image("partners", 1, name="P70")), day="2029-02-09")
    land(bronze, "partners", 90, (90, "u", image("partners", 1, name="P90")), day="2029-01-10")
    late = run_microbatch(spark, str(bronze), lake)
    assert late.cutoff_lsn == 70 and late.applied == {"partners": (1, 0), "accounts": (1, 0)}
    assert not run_microbatch(spark, str(bronze), lake).committed
    # The file that came a month late is found by listing everything.
    assert run_microbatch(spark, str(bronze), lake, lateness_days=None).cutoff_lsn == 90
    assert {r.name for r in lake.silver("partners").read().collect()} == {"P90"}


def test_a_checkpoint_without_days_lists_everything(spark, lake):
    lake, bronze = lake
    lake.checkpoint.replace(spark.createDataFrame([("cdc.public.partners", 0, 3, 3)], CHECKPOINT_SCHEMA.replace(", last_day DATE", "")))
    assert lake.read_checkpoint().first().last_day is None
    land(bronze, "partners", 2, (2, "r", image("partners", 1)), day="2020-01-01")
    land(bronze, "partners", 5, (5, "r", image("partners", 1, name="new")), day="2020-01-01")
    assert run_microbatch(spark, str(bronze), lake).applied == {"partners": (1, 0)}
    assert {str(r.last_day) for r in lake.read_checkpoint().collect()} == {"2020-01-01"}


def test_messages_reach_gold_as_files_do(spark, lake, tmp_path):
    """Through the landing stream and its micro-batch, and as files: the same state, Gold and offsets after each batch."""
    by_file, bronze = lake
    by_message = Lake(spark, str(tmp_path / "other"))
    schema = "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING"

    def send(batch, *messages):
        rows = [(f"cdc.public.{t}", 0, offset, f"2029-02-{11 + batch} 12:00:00", json.dumps(
            {"op": op, "source": {"lsn": lsn}, "before": None, "after": after})) for t, offset, lsn, op, after in messages]
        frame = spark.createDataFrame(rows, schema.replace("TIMESTAMP", "STRING")).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        frame.write.mode("append").parquet(str(tmp_path / "messages"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "messages"))
        land_cdc_stream(stream, str(tmp_path / "landing"), str(tmp_path / "cp"), fmt="parquet", availableNow=True).awaitTermination()
        for t, offset, lsn, op, after in messages:
            land(bronze, t, offset, (lsn, op, after), day=f"2029-02-{11 + batch}")

    def same():
        for name in by_file.contracts:
            rows = [sorted(map(str, x.silver(name).read().collect())) for x in (by_file, by_message)]
            assert rows[0] == rows[1]
        for name in ("fct_partner_net_position", "fct_daily_volume", "dim_accounts"):
            rows = [sorted(map(str, x.gold(name).read().collect())) for x in (by_file, by_message)]
            assert rows[0] == rows[1] and rows[0]
        assert offsets(by_file) == offsets(by_message)

    assert not run_landed_microbatch(spark, str(tmp_path / "landing"), by_message).committed
    send(0, ("partners", 0, 1, "r", image("partners", 1)), ("accounts", 0, 2, "r", image("accounts", 1)),
         ("accounts", 1, 3, "r", image("accounts", 2)), ("transactions", 0, 4, "c", image("transactions", 1)),
         ("ledger_entries", 0, 6, "c", image("ledger_entries", 1)), ("unknown_table", 4, 8, "c", {"id": 1}),
         ("ledger_entries", 1, 7, "c", image("ledger_entries", 2, account_id=uuid(2), entry_type="credit", amount="-10.0000")))
    first = run_landed_microbatch(spark, str(tmp_path / "landing"), by_message)
    assert first == run_microbatch(spark, str(bronze), by_file) and first.applied["ledger_entries"] == (2, 0)
    same()
    assert not run_landed_microbatch(spark, str(tmp_path / "landing"), by_message).committed

    # A broken message stops both; a corrected version behind it doesn't help, as an event is never skipped.
    send(1, ("accounts", 5, 20, "u", image("accounts", 1, status="frozen")), ("accounts", 6, 15, "u", image("accounts", 1, status="closed")))
    second = run_landed_microbatch(spark, str(tmp_path / "landing"), by_message)
    assert second == run_microbatch(spark, str(bronze), by_file) and second.applied == {"accounts": (1, 0)}
    same()
    send(2, ("accounts", 7, 30, "x", {}))
    for run in (lambda: run_landed_microbatch(spark, str(tmp_path / "landing"), by_message), lambda: run_microbatch(spark, str(bronze), by_file)):
        with pytest.raises(ContractError, match="unsupported_op: 1"):
            run()
    same()


def test_landed_messages_are_read_by_day_and_offset(spark, tmp_path):
    """Folders of closed days and other topics are pruned, offsets reach the scan."""
    from tallylake.sources.bronze import inside_ranges, scan_landed_messages

    rows = [("cdc.public.partners", 0, n, f"2029-02-{1 + n % 10:02d} 12:00:00", "{}") for n in range(40)]
    frame = spark.createDataFrame(rows, "topic STRING, partition INT, offset BIGINT, timestamp STRING, value STRING")
    frame.withColumn("timestamp", F.col("timestamp").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING").parquet(str(tmp_path / "in"))
    land_cdc_stream(stream, str(tmp_path / "landing"), str(tmp_path / "cp"), fmt="parquet", availableNow=True).awaitTermination()
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    found = scan_landed_messages(spark, str(tmp_path / "landing")).where("landed_day >= date'2029-02-09'")
    found = found.where(inside_ranges([("cdc.public.partners", 0, 10, 35)])).select("offset", "value")
    assert {r.offset for r in found.collect()} == {18, 19, 28, 29}
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "make_date" in plan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThan(offset,10)" in plan
