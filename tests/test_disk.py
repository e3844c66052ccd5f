"""What the jobs leave on disk while they run."""

import gzip
import time

from pyspark.sql import functions as F

from tallylake.contracts import CONTRACTS
from tallylake.operators.manifest import parse_bronze_keys
from tallylake.session import released_shuffles
from tallylake.sources.bronze import scan_new_files
from tallylake.sources.tables import VersionedTable

TOPIC = "cdc.public.accounts"


def test_compressed_objects_are_found_and_read(spark, tmp_path):
    folder = tmp_path / "topics" / TOPIC / "year=2031" / "month=05" / "day=04"
    folder.mkdir(parents=True)
    for offset in (4, 9):
        (folder / f"{TOPIC}+2+{offset:010d}.json.gz").write_bytes(gzip.compress(f'{{"at": {offset}}}\n\n'.encode()))
    keys = [f"topics/{TOPIC}/year=2031/month=05/day=04/{TOPIC}+2+0000000009.json{end}" for end in (".gz", "", ".gz.tmp", ".zip")]
    found = parse_bronze_keys(spark.createDataFrame([(k,) for k in keys], "key STRING")).collect()
    assert [(r.key, r.partition, r.start_offset, r.table) for r in found] == [(k, 2, 9, "accounts") for k in keys[:2]]
    lines = scan_new_files(spark, [str(folder)], [(TOPIC, 2, 4, 9)])
    assert [r.value for r in lines.collect()] == ['{"at": 9}']


def test_shuffles_go_with_their_statement(spark, tmp_path):
    def shuffled() -> int:
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(n).getName().startswith("shuffle_") for n in range(files.size()))

    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    kept, frames = shuffled(), []
    with released_shuffles(spark):
        for n in range(3):
            frames.append(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
            frames[-1].write.parquet(str(tmp_path / str(n)))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    until = time.time() + 20
    while shuffled() > kept and time.time() < until:
        time.sleep(0.2)
    assert shuffled() <= kept
    # Run again, a frame makes its shuffle again.
    assert frames[0].count() == 7


def test_states_are_written_compactly(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "table"))
    table.replace(spark.range(5).withColumn("t", F.lit(CONTRACTS["accounts"].name)))
    assert list((tmp_path / "table").rglob("*.zstd.parquet"))
