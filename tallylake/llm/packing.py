"""Best-fit packing with certificates.

Lengths are dealt out evenly to partitions, each packed by best-fit decreasing. Lower bounds from
dual feasible functions say how few sequences a partition, and the whole, can need. While the whole
has a gap, sequences with room left give their documents back; these are dealt anew and repacked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import crc_u32, encoding, in_steps, table, tokenizer_path, written
from tallylake.llm.registry import query

CAPACITY = 2048
#: Items a partition packs at once; what a task holds grows with this alone.
PARTITION_ITEMS = 50_000
#: Rounds after the first; each one repacks only what lay in sequences with room left.
MAX_ROUNDS = 8
#: The family of rounding functions with k = 1 .. this.
ROUNDING_STEPS = 40


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Sequences that any packing needs. ``counts[n]``: items of length n, for n = 0 .. capacity.

    The largest of two families of dual feasible functions. The first takes a threshold a: an item
    over capacity - a counts as a whole sequence, one below a as nothing. The second, for k, rounds
    a length down to a multiple of capacity / (k + 1) and counts it in k-ths.
    """
    length = np.arange(capacity + 1, dtype=np.int64)
    counts = counts.astype(np.int64)
    number, total = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(counts * length))
    half = capacity // 2
    a = np.arange(half + 1)
    whole = number[-1] - number[capacity - a + 1]
    large = number[capacity - a + 1] - number[half + 1]
    large_sum = total[capacity - a + 1] - total[half + 1]
    small_sum = total[half + 1] - total[a]
    best = int(np.max(whole + large + np.maximum(0, -((large * capacity - large_sum - small_sum) // capacity))))
    for k in range(1, ROUNDING_STEPS + 1):
        steps = (k + 1) * length
        scaled = np.where(steps % capacity == 0, k * length, steps // capacity * capacity)
        best = max(best, -(-int(counts @ scaled) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each item, and how full each sequence is.

    Each item, longest first, goes where least room stays; among equal ones to the sequence that came last to that room.
    """
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some sequence has room r
    filled: list[int] = []
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, own = capacity, len(filled)
            filled.append(0)
        where[i], offset[i] = own, capacity - room
        filled[own] += n
        if room > n:
            with_room[room - n].append(own)
            rooms |= 1 << (room - n)
    return where, offset, np.array(filled, np.int64)


def pack(items: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, dict[str, int]]:
    """``items`` with sequence_id and offset, and the report: sequences, bound, rounds, certified, partitions.

    Input: any columns and ``length``, whole numbers from 1 to ``capacity`` (any other value, null
    too, is an error); columns named sequence_id, offset, or starting with ``_pack`` are replaced.
    Equal rows are items of their own. No rows give no rows and a report of zeros.
    ``certified`` counts partitions of the first round that reach their own bound.
    """
    spark = items.sparkSession
    added = ["sequence_id", "offset", "_pack_full", "_pack_bound", "_pack_used", "_pack_part"]
    items = items.drop(*added)
    kinds = {"sequence_id": "long", "offset": "long", "_pack_full": "boolean", "_pack_bound": "long", "_pack_used": "long", "_pack_part": "int"}
    ddl = items.schema.toDDL() + "".join(f", {c} {k}" for c, k in kinds.items())

    def packed_by(number: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            given = [b for b in batches if b.num_rows]
            if not given:
                return
            rows = pa.Table.from_batches(given)
            if rows["length"].null_count:
                raise ValueError("An item has no length.")
            lengths = rows["length"].to_numpy().astype(np.int64)
            if lengths.min() < 1 or lengths.max() > capacity:
                raise ValueError(f"A length is outside 1 .. {capacity}.")
            where, offset, filled = best_fit_decreasing(lengths, capacity)
            bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
            part, n = TaskContext.get().partitionId(), len(lengths)
            made = [
                pa.array((number << 56) + (part << 24) + where), pa.array(offset), pa.array(filled[where] == capacity),
                pa.array(np.full(n, bound)), pa.array(np.full(n, len(filled))), pa.array(np.full(n, part, np.int32)),
            ]
            for name, values in zip(added, made, strict=True):
                rows = rows.append_column(name, values)
            yield from rows.to_batches(max_chunksize=10_000)

        return run

    rows = items.groupBy("length").count().where(F.col("length").between(1, capacity)).collect()  # capacity rows at most
    counts = np.zeros(capacity + 1, np.int64)
    for row in rows:
        counts[row["length"]] = row["count"]
    bound = lower_bound(counts, capacity)
    kept: list[DataFrame] = []
    loose, number, settled, before = items, 0, 0, None
    report = {"sequences": 0, "bound": bound, "rounds": 0, "certified": 0, "partitions": 0}
    while True:
        n = int(counts.sum()) if number == 0 else loose.count()
        dealt = loose.repartition(max(1, -(-n // PARTITION_ITEMS)))
        placed = written(dealt.mapInArrow(packed_by(number), ddl), "packed")
        # One row per partition; the sequences of each, those that are full, and its bound.
        parts = placed.groupBy("_pack_part", "_pack_used", "_pack_bound").agg(
            F.sum(F.when(F.col("_pack_full") & (F.col("offset") == 0), 1).otherwise(0)).alias("full")
        ).agg(
            F.sum("_pack_used").alias("used"), F.sum("full").alias("full"), F.count("*").alias("parts"),
            F.sum(F.when(F.col("_pack_used") == F.col("_pack_bound"), 1).otherwise(0)).alias("certified"),
        ).first()
        used, full = parts["used"] or 0, parts["full"] or 0
        if number == 0:
            report |= {"certified": parts["certified"] or 0, "partitions": parts["parts"]}
        report |= {"sequences": settled + used, "rounds": number}
        alone = parts["parts"] <= 1 and number > 0
        if settled + used <= bound or number == MAX_ROUNDS or alone or (before is not None and used >= before):
            kept.append(placed)
            break
        kept.append(placed.where("_pack_full"))
        loose = placed.where(~F.col("_pack_full")).drop(*added)
        settled, before, number = settled + full, used - full, number + 1
    whole = kept[0]
    for more in kept[1:]:
        whole = whole.unionByName(more)
    return whole.drop(*added[2:]), report


_PIECE = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut only if longer than ``capacity``.

    Of a longer document every piece is full but the first. A null text counts as empty: the end id
    alone. Equal rows are documents of their own.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding(tokenizer) as own:
            for batch, texts in in_steps(batches):
                ids, sizes = own.encode(texts)
                ids = np.insert(ids, np.cumsum(sizes), np.array(end_id, own.kind)).astype("<u4")
                sizes = sizes + 1
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first = sizes - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                begin = (np.cumsum(sizes) - sizes)[doc] + start
                crc = [crc_u32(ids[a : a + n]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()),
                ], schema=_PIECE)

    given = docs.select(F.col("doc_id").cast("long"), "text")
    return given.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int = 0) -> tuple[DataFrame, dict[str, int]]:
    return pack(written(token_pieces(docs, tokenizer, end_id), "pieces"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), tokenizer_path())[0]
