import datetime

from tallylake.checks import cdc_queries as c
from tallylake.checks import fixtures as x
from tallylake.operators.latest import latest_by_lsn
from tallylake.session import new_run_folder
from tallylake.sources.tables import SilverTable
from tallylake.streaming.cdc import apply_cdc_stream
from tallylake.streaming.landing import land_cdc_stream

SF = "/root/testdata/sf0.001"
UTC = datetime.timezone.utc


def test_a_stream_gives_the_batch_state_and_resumes(spark, tmp_path):
    contract = x.EVENTS
    folder = x.event_folder(spark, SF)
    table = SilverTable(spark, str(tmp_path / "silver"), contract)

    def run():
        source = (
            spark.readStream.schema("value STRING, year INT, month INT, day INT")
            .option("maxFilesPerTrigger", 10).text(folder).select("value")
        )
        apply_cdc_stream(source, table, str(tmp_path / "cp"), str(tmp_path / "st")).awaitTermination()

    run()
    batch = latest_by_lsn(c.typed(spark, SF), contract.primary_key)
    columns = contract.columns
    assert {tuple(r) for r in table.read().collect()} == {
        tuple(r) for r in batch.select(columns).collect()
    }
    published = table.published()
    run()
    assert table.published() == published


def test_landing_uses_the_record_day_of_the_business_zone(spark, tmp_path):
    late = datetime.datetime(2026, 8, 13, 1, 30, tzinfo=UTC)
    rows = [("cdc.public.accounts", 2, 7, late, '{"op":"c"}')]
    messages = spark.createDataFrame(
        rows, "topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, value STRING"
    )
    messages.write.parquet(str(tmp_path / "in"))
    for fmt in ("text", "parquet"):
        stream = spark.readStream.schema(messages.schema).parquet(str(tmp_path / "in"))
        land_cdc_stream(
            stream, str(tmp_path / fmt), str(tmp_path / f"cp-{fmt}"), fmt=fmt, availableNow=True
        ).awaitTermination()
    folder = tmp_path / "text" / "topic=cdc.public.accounts" / "year=2026" / "month=08" / "day=12"
    text, = [p for p in folder.iterdir() if p.suffix == ".txt"]
    assert text.read_text() == '{"op":"c"}\n'
    kept = spark.read.parquet(str(tmp_path / "parquet")).first()
    assert (kept.partition, kept.offset, kept.value) == (2, 7, '{"op":"c"}')


def test_a_batch_is_applied_once_and_its_staged_folder_goes(spark, tmp_path, monkeypatch):
    """Ten batches, then restarts that lose what the stream itself knew of the last one."""
    from tallylake.streaming import cdc

    contract, folder = x.EVENTS, x.event_folder(spark, SF)
    table, staging, checkpoint = SilverTable(spark, str(tmp_path / "silver"), contract), tmp_path / "st", tmp_path / "cp"
    read = []
    real = cdc.stage_events
    monkeypatch.setattr(cdc, "stage_events", lambda *args: read.append(1) or real(*args))

    def run():
        source = spark.readStream.schema("value STRING, year INT, month INT, day INT").option("maxFilesPerTrigger", 3).text(folder)
        apply_cdc_stream(source.select("value"), table, str(checkpoint), str(staging)).awaitTermination()

    run()
    batches = len(list((checkpoint / "commits").glob("[0-9]*")))
    assert batches >= 10 and len(read) == batches
    assert not [p for p in staging.iterdir() if p.name.startswith("batch=")]
    published = table.published()

    # The commit of the last batch is lost: the stream gives it again, and nothing is read or written.
    last = str(batches - 1)

    def lose_commit():
        for name in (last, f".{last}.crc"):
            (checkpoint / "commits" / name).unlink()

    lose_commit()
    run()
    assert len(read) == batches and table.published() == published and (checkpoint / "commits" / last).exists()
    # The record is lost too: the batch is repeated, and the LSN rule leaves the state as it is.
    lose_commit()
    done = cdc.VersionedTable(spark, f"{staging}/applied")
    done.replace(spark.createDataFrame([("another stream", 99)], cdc.APPLIED_SCHEMA))
    run()
    assert len(read) == batches + 1 and table.published() == published
    assert not [p for p in staging.iterdir() if p.name.startswith("batch=")]


def test_late_rows_are_counted_and_state_stays_bounded(spark, tmp_path):
    from tallylake.streaming.observations import STATE_STORE, LateRows, dedup_observation_stream, use_large_state

    schema, listener = "event_id STRING, ingested_time TIMESTAMP", LateRows()
    use_large_state(spark)
    spark.streams.addListener(listener)
    try:
        def feed(day, *ids):
            rows = [(i, datetime.datetime(2031, 5, day, 12, tzinfo=UTC)) for i in ids]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = dedup_observation_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
            query = (
                stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
                .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            )
            query.awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
            return str(query.runId)

        runs = [feed(day, *[f"{day}-{n}" for n in range(20)], *[f"{day}-{n}" for n in range(5)]) for day in range(1, 9)]
        # One row of the first day, a week behind, and one repeat of today.
        late = feed(8, "8-0"), feed(1, "1-99")
        kept = spark.read.parquet(str(tmp_path / "out"))
        assert kept.count() == kept.distinct().count() == 8 * 20
        assert listener.dropped[late[1]] == 1 and not any(listener.dropped[r] for r in runs)
        assert all(max(listener.state_rows[r]) <= 60 for r in runs) and list((tmp_path / "cp" / "state").rglob("*.changelog"))
    finally:
        spark.streams.removeListener(listener)
        for key in STATE_STORE:
            spark.conf.unset(key)


def test_run_folders_are_never_shared(spark):
    assert new_run_folder(spark, "a") != new_run_folder(spark, "a")
