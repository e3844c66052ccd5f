"""Token ids as flat binary files.

A folder holds, for each part, ``<name>.bin`` (all ids, little-endian unsigned, 16 bits where the
vocabulary allows, else 32), ``<name>.off`` (64-bit places of the part's documents, one more than
there are documents, counted from the part's first id) and ``<name>.doc`` (64-bit document ids), and
``manifest.json``, which lists the parts in document order with the base of each: the prefix sum of
the ids in the parts before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import crc_u32, encoder, in_steps, table, tokenizer_path, written
from tallylake.llm.registry import query
from tallylake.session import new_run_folder

#: How a null document id stands in a ``.doc`` file.
NULL_ID = -(1 << 63)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None) -> None:
    """Encode every text and write the files below ``folder``, in ascending order of doc_id.

    Input columns: doc_id, text; others are ignored. A null text counts as empty and has the end id
    only; a null doc_id comes first; equal ids are ordered by text. An empty table gives a manifest
    without parts. ``folder`` has to be reachable for all executors. Each task writes files under a
    name of its own and reports them as rows, so what a failed or repeated task leaves behind is
    never listed. The driver sees one row per part.
    """
    spark = docs.sparkSession

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, store, at = encoder(tokenizer), None, 0
        for batch, texts in in_steps(batches):
            if store is None:
                store, base = fs.FileSystem.from_uri(f"{folder}/{uuid.uuid4().hex}")
                store.create_dir(base.rpartition("/")[0])
                ids_file, off_file, doc_file = (store.open_output_stream(f"{base}.{x}") for x in ("bin", "off", "doc"))
                off_file.write(np.zeros(1, "<i8").tobytes())
                documents = 0
            ids, sizes = own.encode(texts)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(sizes), np.array(end_id, own.kind))
                sizes = sizes + 1
            ids_file.write(ids.tobytes())
            off_file.write((at + np.cumsum(sizes)).astype("<i8").tobytes())
            doc_file.write(batch.column("doc_id").fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
            at += len(ids)
            documents += len(texts)
        if store is not None:
            for file in (ids_file, off_file, doc_file):
                file.close()
            made = [TaskContext.get().partitionId(), base.rpartition("/")[2], own.kind.str, at, documents]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in made], names=["part", "name", "kind", "ids", "documents"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    parts = written(rows.mapInArrow(run, "part long, name string, kind string, ids long, documents long"), "token-parts")
    listed = parts.orderBy("part").collect()  # one row per part
    bases = [0, *accumulate(p.ids for p in listed)]
    manifest = [
        {"name": p.name, "kind": p.kind, "base": b, "ids": p.ids, "documents": p.documents}
        for p, b in zip(listed, bases, strict=False)
    ]
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    with store.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps({"ids": bases[-1], "parts": manifest}).encode())


def read_manifest(folder: str) -> dict:
    store, path = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{path}/manifest.json") as file:
        return json.loads(file.read())


def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the folder is mounted, else read."""
    store, path = fs.FileSystem.from_uri(f"{folder}/{name}")
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if store.get_file_info(path).size else np.zeros(0, kind)
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), kind)


_DOCUMENT = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """From the files alone: doc_id, start, n_tokens, ids_crc32 of every document. A task maps one part at a time."""
    parts = [(p["name"], p["kind"], p["base"]) for p in read_manifest(folder)["parts"]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = mapped(folder, f"{row['name']}.bin", row["kind"])
                off = mapped(folder, f"{row['name']}.off", "<i8")
                doc = np.array(mapped(folder, f"{row['name']}.doc", "<i8"))
                crc = [crc_u32(ids[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc, mask=doc == NULL_ID), pa.array(row["base"] + off[:-1]), pa.array(np.diff(off)),
                    pa.array(crc, pa.int64()),
                ], schema=_DOCUMENT)

    given = spark.createDataFrame(parts, "name string, kind string, base long")
    dealt = given.repartitionByRange(max(1, len(parts)), "base")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query("op2_token_files")
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, tokenizer_path(), end_id=2)
    return read_documents(spark, folder)
