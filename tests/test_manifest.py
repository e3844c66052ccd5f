import pytest
from pyspark.sql import functions as F

from tallylake.operators import manifest as m
from tallylake.sources.bronze import list_bronze_objects, relative_key

ACCOUNTS = "cdc.public.accounts"


def key(topic=ACCOUNTS, partition=0, offset="0000000050", name=None, prefix="topics"):
    return f"{prefix}/{topic}/year=2026/month=09/day=23/{name or topic}+{partition}+{offset}.json"


def objects(spark, *keys):
    return m.parse_bronze_keys(spark.createDataFrame([(k,) for k in keys], "key STRING"))


def checkpoints(spark, *rows):
    return spark.createDataFrame(list(rows), m.CHECKPOINT_SCHEMA)


def test_a_key_is_parsed_and_others_are_ignored(spark):
    found = objects(
        spark, key(), key(name="cdc.public.other"), key(prefix="archive"), key(offset="x"),
        key() + ".tmp", key() + "\n", "topics/", key(topic="other.schema.accounts"),
    ).orderBy("topic").collect()
    assert [(r.topic, r.partition, r.start_offset, r.table) for r in found] == [
        (ACCOUNTS, 0, 50, "accounts"), ("other.schema.accounts", 0, 50, "accounts"),
    ]
    assert found[0].uri == f"s3://bronze/{key()}"


def test_only_offsets_above_the_checkpoint_are_new(spark):
    found = objects(spark, key(offset="9"), key(offset="10"), key(offset="11"),
                    key(partition=1, offset="0"))
    new = m.unprocessed_objects(found, checkpoints(spark, (ACCOUNTS, 0, 10)))
    assert sorted((r.partition, r.start_offset) for r in new.collect()) == [(0, 11), (1, 0)]
    assert m.unprocessed_objects(found, checkpoints(spark)).count() == 4


def test_unknown_tables_are_listed_and_advance(spark):
    found = objects(spark, key(), key(topic="cdc.public.unknown", offset="7"))
    listed = m.batch_manifest(found, ["accounts"]).collect()
    assert {r.table: r.has_contract for r in listed} == {"accounts": True, "unknown": False}
    after = m.next_checkpoints(checkpoints(spark, ("quiet", 3, 5), (ACCOUNTS, 0, 99)), found)
    assert {tuple(r) for r in after.collect()} == {
        ("quiet", 3, 5), (ACCOUNTS, 0, 99), ("cdc.public.unknown", 0, 7),
    }


def test_order_is_numeric_and_complete(spark, tmp_path):
    keys = [key(partition=p, offset=str(o)) for p in (0, 1, 10) for o in (0, 9, 10, 100, 5000)]
    keys += [key(topic="cdc.public.zebra", offset="3")]
    ordered = m.manifest_order(objects(spark, *reversed(keys)), str(tmp_path / "some")).collect()
    assert [r.key for r in ordered] == keys
    assert [r.position for r in ordered] == list(range(1, len(keys) + 1))
    assert m.manifest_order(objects(spark, "none"), str(tmp_path / "none")).count() == 0


def test_one_partition_with_sparse_offsets_is_numbered_in_many_tasks(spark, tmp_path):
    n = F.col("id")
    offset = F.pmod(n * 7919, F.lit(100_000)) * 1_000_003
    rows = spark.range(100_000).select(
        F.lit(ACCOUNTS).alias("topic"), F.lit(0).cast("bigint").alias("partition"), offset.alias("start_offset"), n.cast("string").alias("key")
    )
    ordered = m.manifest_order(rows, str(tmp_path / "order"))
    assert ordered.where(F.col("start_offset") != (F.col("position") - 1) * 1_000_003).isEmpty() and ordered.count() == 100_000
    written = spark.read.parquet(str(tmp_path / "order")).groupBy(F.shiftright("_id", 33).alias("range")).count().collect()
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(written) == ranges and max(r["count"] for r in written) < 2 * 100_000 / ranges


@pytest.mark.parametrize("previous, batch, committed", [
    (None, 5, True), (5, 5, True), (5, 6, True), (6, 5, False), (5, None, False),
])
def test_the_checkpoint_never_goes_back(spark, previous, batch, committed):
    rows = [] if previous is None else [(previous,)]
    decision = m.commit_decision(
        spark.createDataFrame(rows, "lsn BIGINT"), spark.createDataFrame([(batch,)], "lsn BIGINT")
    )
    assert decision.first().committed is committed


def test_listing_gives_keys_below_the_root(spark, tmp_path):
    folder = tmp_path / "topics" / ACCOUNTS / "year=2026" / "month=09" / "day=23"
    folder.mkdir(parents=True)
    (folder / f"{ACCOUNTS}+0+5.json").write_text("{}")
    row, = list_bronze_objects(spark, str(tmp_path)).collect()
    assert row.key == key(offset="5") and row.length == 2
    s3 = spark.range(1).select(relative_key(F.lit("s3a://bucket/root/a/b.json"), "s3a://bucket/root"))
    assert s3.first()[0] == "a/b.json"
