"""What the pipeline's stages share: rows that were decided on are taken out of the documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.common import written

#: Lists of rows up to this many are broadcast after they are counted: at most some 30 MB. Longer ones are shuffled.
BROADCAST_ROWS = 1_000_000


def text_key() -> Column:
    """With doc_id, what operators tell a row by."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    """A struct of all columns, whatever their names, and the key that operators return."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"), text_key().alias("own_key"))


def _match(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key"))
    return rows.join(listed, same, how)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id and text_key aren't in ``rejected``."""
    listed = written(rejected.select("doc_id", "text_key").distinct(), "rejected")
    if listed.count() <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    return _match(_keyed(docs), listed, "left_anti").select("row.*")


def once(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """One row for each doc_id and text_key in ``repeated``, and all other rows of ``docs``."""
    listed = written(repeated.select("doc_id", "text_key").distinct(), "repeated")
    n = listed.count()
    if not n:
        return docs
    if n <= BROADCAST_ROWS:
        listed = F.broadcast(listed)
    rows = _keyed(docs)
    single = _match(rows, listed, "left_semi").dropDuplicates(["own_id", "own_key"])
    return _match(rows, listed, "left_anti").unionByName(single).select("row.*")
