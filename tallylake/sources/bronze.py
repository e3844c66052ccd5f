"""Raw change events as landed: newline-delimited JSON, read as text and never inferred."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_PREFIX = "cdc.public."
_DAY_SCHEMA = "value STRING, year INT, month INT, day INT"


def scan_cdc_json(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per event line; blank lines are no events."""
    if not paths:
        raise ValueError("The list of bronze files is empty.")
    return drop_blank(spark.read.text(paths).select("value"))


def drop_blank(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("value").rlike(r"\S"))


def scan_bronze_paths(
    spark: SparkSession,
    topic_folder: str,
    date: str | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """Events of an explicit file list, else of one day, else of all days.

    A day is a filter on the partition columns of ``year=/month=/day=``, so
    only that day's folder is listed.
    """
    if files is not None:
        return scan_cdc_json(spark, files)
    events = spark.read.schema(_DAY_SCHEMA).text(topic_folder)
    if date is not None:
        year, month, day = (int(part) for part in date.split("-"))
        events = events.where(
            (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
        )
    return drop_blank(events.select("value"))


#: Up to so many folders, Spark lists one after the other, with a job for each larger one below.
LISTED_IN_TURN = 32


def listing_roots(spark: SparkSession, root: str) -> list[str]:
    """What below ``root`` holds all its objects and is many enough that Spark lists it in one job, else ``root``.

    Levels of few folders are opened here. A level of many plain files stays with its folder, and so does one with
    names that Spark skips or would take for patterns.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = path(root)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return [root]
    folders, files, kept = [top], [], [root]
    while folders and len(folders) <= LISTED_IN_TURN:
        inside = [s for folder in folders for s in fs.listStatus(folder)]
        names = [s.getPath().getName() for s in inside]
        if any(name[0] in "._" or name.endswith("._COPYING_") or set(name) & set("{}[]*?\\") for name in names):
            break
        folders = [s.getPath() for s in inside if s.isDirectory()]
        files += [s.getPath() for s in inside if not s.isDirectory()]
        if len(files) > LISTED_IN_TURN:
            break
        kept = [p.toString() for p in (*folders, *files)] or kept
    return kept


def list_bronze_objects(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """Key, size and time of every object below ``root``, or below some folders of it; contents are not read."""
    if folders == []:
        schema = "path STRING, length BIGINT, modificationTime TIMESTAMP, key STRING"
        return spark.createDataFrame([], schema)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(listing_roots(spark, root) if folders is None else folders)
        .select("path", "length", "modificationTime")
    )
    return listing.withColumn("key", relative_key(F.col("path"), root))


def open_day_folders(spark: SparkSession, root: str, since: dict[str, datetime.date]) -> list[str]:
    """The day folders below ``topics/`` that may hold new files: those from a topic's day on, all of a topic without one.

    Years, months and days before it are left out by their folder names, so what the driver looks at
    grows with the open days, not with the history.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    top = path(f"{root.rstrip('/')}/topics")
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folders(parent) -> list:
        return [s.getPath() for s in fs.listStatus(parent) if s.isDirectory()]

    found = []
    for topic in folders(top) if fs.exists(top) else []:
        first = since.get(topic.getName())
        low = (first.year, first.month, first.day) if first else (0, 0, 0)
        level = [((), topic)]
        for name in ("year", "month", "day"):
            deeper = []
            for place, parent in level:
                for child in folders(parent):
                    key, _, number = child.getName().partition("=")
                    if key == name and number.isdigit() and (*place, int(number)) >= low[: len(place) + 1]:
                        deeper.append(((*place, int(number)), child))
            level = deeper
        found += [child.toString() for _, child in level]
    return sorted(found)


_LANDED = "value STRING, partition BIGINT, offset BIGINT, timestamp TIMESTAMP, topic STRING, year INT, month INT, day INT"


def scan_landed_messages(spark: SparkSession, landing: str) -> DataFrame:
    """Messages that ``land_cdc_stream`` wrote as Parquet, of committed batches only; ``landed_day`` is the day of the folder."""
    return spark.read.schema(_LANDED).parquet(landing).withColumn("landed_day", F.make_date("year", "month", "day"))


def inside_ranges(ranges: list[tuple[str, int, int, int]]) -> Column:
    """Whether a landed message is inside one of the ranges (topic, partition, after, up to)."""
    inside = F.lit(False)
    for topic, partition, after, upto in ranges:
        same = (F.col("topic") == topic) & (F.col("partition") == partition)
        inside = inside | (same & (F.col("offset") > after) & (F.col("offset") <= upto))
    return inside


def relative_key(path: Column, root: str) -> Column:
    """The part of a full path after ``root``; listings may add a scheme in front of it."""
    anchor = root.split(":", 1)[-1].lstrip("/").rstrip("/") + "/"
    start = F.position(F.lit(anchor), path)
    return F.substring(path, start + len(anchor), F.length(path))


def scan_new_files(
    spark: SparkSession, folders: list[str], ranges: list[tuple[str, int, int, int]]
) -> DataFrame:
    """Events of the files inside frozen offset ranges.

    ``ranges`` holds (topic, partition, after, up to): one entry per broker
    partition, whatever the number of files; ``folders`` are the day folders
    that hold them. The condition only looks at the file name, so Spark drops
    other files while listing, and no file list passes through the driver.
    """
    name = F.col("_metadata.file_name")
    offset = F.regexp_extract(name, r"\+(\d+)\.json(\.gz)?$", 1).try_cast("bigint")
    inside = F.lit(False)
    for topic, partition, after, upto in ranges:
        inside = inside | (
            name.startswith(f"{topic}+{partition}+") & (offset > after) & (offset <= upto)
        )
    return drop_blank(spark.read.text(folders).where(inside).select("value"))
