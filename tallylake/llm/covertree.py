"""Vector code compression: one codebook for each part of the vectors, by Lloyd's rounds over cover trees.

Vectors are taken in blocks, in the partitions where they lie. A block has for each part position a cover tree:
the children of a node lie further apart than a scale that shrinks from level to level, and cover all its points
within it. A node's points stand in one run, so that cumulative sums give their total. In a round a node keeps
the codebook entries that some point of it may be nearest to, by the triangle inequality; where one is left,
the whole subtree goes there at once. Only ambiguous nodes descend, and only points of ambiguous leaves are
compared themselves. Distances are whole numbers, so ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallylake.llm.common import table, written
from tallylake.llm.registry import query

#: Vectors of a block: the most that one row of the table of trees holds.
BLOCK_VECTORS = 4096
#: A child's scale is its parent's radius divided by this.
SHRINK = 1.5
#: A node of so many points isn't split, nor one that would have a child for fewer than FALLS_APART points each.
LEAF, FALLS_APART = 16, 3
#: Whole numbers up to this have squared distances (up to 64 components a part) that doubles hold exactly.
EXACT = 1 << 22

_NODE = np.dtype([("start", "<i4"), ("end", "<i4"), ("centre", "<i4"), ("first", "<i4"), ("last", "<i4"), ("radius", "<f8")])


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` and ``y`` (whole numbers): doubles where these are exact, else Python's integers."""
    small = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) <= EXACT and x.shape[1] <= 64
    if small:
        x, y = x.astype(np.float64), y.astype(np.float64)
        return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)
    away = x.astype(object)[:, None, :] - y.astype(object)[None, :, :]
    return (away * away).sum(axis=2)


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers of the given spans, one span after the other."""
    sizes = ends - starts
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - (upto - sizes), sizes)


@dataclass
class CoverTree:
    """``points`` in the order in which nodes hold them, as spans; a node's children are consecutive nodes."""

    points: np.ndarray
    nodes: np.ndarray

    @staticmethod
    def build(given: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the points, and the nodes, the root first and each level after the one above."""
        n = len(given)
        order = np.arange(n)
        if not n:
            return order, np.zeros(0, _NODE)
        exact = np.abs(given).max(initial=0) <= EXACT and given.shape[1] <= 64
        x = given.astype(np.float64)

        def away(points: np.ndarray, centre: int) -> np.ndarray:
            d = points - x[centre]
            return np.sqrt(np.einsum("ij,ij->i", d, d))

        # Beyond exact doubles the root is a leaf, and all points are compared.
        nodes = [(0, n, 0, 0, 0, float(away(x, 0).max()) if exact else np.inf)]
        at = 0
        while at < len(nodes):
            start, end, centre, _, _, radius = nodes[at]
            size = end - start
            if exact and size > LEAF and radius > 0:
                points = x[order[start:end]]
                near, owner, centres = away(points, centre), np.zeros(size, np.int64), [centre]
                while (far := int(near.argmax())) >= 0 and near[far] > radius / SHRINK and FALLS_APART * len(centres) <= size:
                    own = away(points, int(order[start + far]))
                    closer = own < near
                    owner[closer] = len(centres)
                    near[closer] = own[closer]
                    centres.append(int(order[start + far]))
                if near.max() <= radius / SHRINK:
                    by = np.argsort(owner, kind="stable")
                    order[start:end], near = order[start:end][by], near[by]
                    sizes = np.bincount(owner, minlength=len(centres))
                    begins = np.cumsum(sizes) - sizes
                    radii = np.maximum.reduceat(near, begins)
                    nodes[at] = (start, end, centre, len(nodes), len(nodes) + len(centres), radius)
                    nodes += [
                        (start + b, start + b + s, c, 0, 0, r)
                        for b, s, c, r in zip(begins.tolist(), sizes.tolist(), centres, radii.tolist(), strict=True)
                    ]
            at += 1
        made = np.array(nodes, _NODE)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        made["centre"] = place[made["centre"]]
        return order, made

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The nearest of ``entries`` (the first among equals): nodes that go as a whole with their entry and span, points with theirs."""
        nodes, points = self.nodes, self.points
        whole: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 3]
        single: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 2]
        active, kept = np.arange(min(1, len(nodes))), np.ones((min(1, len(nodes)), len(entries)), bool)
        while len(active):
            own = nodes[active]
            d = np.sqrt(np.maximum(squared_distances(points[own["centre"]], entries).astype(np.float64), 0))
            d[~kept] = np.inf
            reach = d.min(axis=1) + 2 * own["radius"]
            # The slack outweighs what roots and sums are rounded by.
            kept = d <= (reach + 1e-9 * (1 + reach))[:, None]
            sure = kept.sum(axis=1) == 1
            whole.append((d[sure].argmin(axis=1), own["start"][sure], own["end"][sure]))
            leaf = ~sure & (own["first"] == own["last"])
            at = _spans(own["start"][leaf], own["end"][leaf])
            if len(at):
                exact = squared_distances(points[at], entries)
                exact[~np.repeat(kept[leaf], (own["end"] - own["start"])[leaf], axis=0)] = np.inf
                single.append((at, exact.argmin(axis=1)))
            inner = ~sure & ~leaf
            active = _spans(own["first"][inner], own["last"][inner])
            kept = np.repeat(kept[inner], (own["last"] - own["first"])[inner], axis=0)
        return (*(np.concatenate(x) for x in zip(*whole, strict=True)), *(np.concatenate(x) for x in zip(*single, strict=True)))

    def totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and numbers of the points nearest to each entry; subtrees by differences of cumulative sums."""
        upto = np.concatenate([np.zeros((1, self.points.shape[1]), np.int64), np.cumsum(self.points, axis=0)])
        entry, start, end, at, own = self.assign(entries)
        sums, counts = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
        np.add.at(sums, entry, upto[end] - upto[start])
        np.add.at(counts, entry, end.astype(np.int64) - start)
        np.add.at(sums, own, self.points[at])
        np.add.at(counts, own, 1)
        return sums, counts

    def codes(self, entries: np.ndarray) -> np.ndarray:
        """The nearest entry of each point, in the tree's order."""
        entry, start, end, at, own = self.assign(entries)
        found = np.empty(len(self.points), np.int64)
        found[_spans(start, end)] = np.repeat(entry, end - start)
        found[at] = own
        return found


def _parts(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return [np.ascontiguousarray(p) for p in np.split(vectors, parts, axis=1)]


def plant_trees(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """Blocks of rows with their trees, written: ids, labels, n, points, orders and nodes (both by part).

    A partition's rows are taken as they come, BLOCK_VECTORS at a time, so nothing is shuffled.
    """
    label = vectors.schema["label"].dataType.simpleString()

    def block(ids: pa.Array, labels: pa.Array, points: np.ndarray) -> pa.RecordBatch:
        built = [CoverTree.build(p) for p in _parts(points, parts)]
        arrays = [
            pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.ListArray.from_arrays([0, len(labels)], labels), pa.array([len(ids)]),
            pa.array([points.astype("<i8").tobytes()]), pa.array([[o.astype("<i4").tobytes() for o, _ in built]]), pa.array([[t.tobytes() for _, t in built]]),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["ids", "labels", "n", "points", "orders", "nodes"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, pa.Array, np.ndarray]] = []
        for batch in batches:
            column = batch.column("components")
            points = np.zeros((batch.num_rows, width), np.int64)
            sizes = np.diff(column.offsets.to_numpy())
            rows = np.repeat(np.arange(len(sizes)), sizes)
            points[rows, _spans(np.zeros(len(sizes), np.int64), sizes)] = column.flatten().to_numpy()
            done = 0
            while done < batch.num_rows:
                take = min(batch.num_rows - done, BLOCK_VECTORS - sum(len(h[0]) for h in held))
                held.append((batch.column("id").slice(done, take), batch.column("label").slice(done, take), points[done : done + take]))
                done += take
                if sum(len(h[0]) for h in held) == BLOCK_VECTORS:
                    yield block(*_joined(held))
                    held = []
        if held:
            yield block(*_joined(held))

    schema = f"ids array<bigint>, labels array<{label}>, n bigint, points binary, orders array<binary>, nodes array<binary>"
    return written(vectors.select("id", "label", "components").mapInArrow(run, schema), "cover-trees")


def _joined(held: list[tuple[pa.Array, pa.Array, np.ndarray]]) -> tuple[pa.Array, pa.Array, np.ndarray]:
    return pa.concat_arrays([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]), np.concatenate([h[2] for h in held])


def _blocks(batches: Iterable[pa.RecordBatch], parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[tuple[np.ndarray, CoverTree]]]]:
    """One block after the other: its row, its vectors, and for each part the order and the tree."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            n = row.column("n")[0].as_py()
            points = np.frombuffer(row.column("points")[0].as_py(), "<i8").reshape(n, -1)
            orders, nodes = row.column("orders")[0].as_py(), row.column("nodes")[0].as_py()
            trees = []
            for p, o, t in zip(_parts(points, parts), orders, nodes, strict=True):
                order = np.frombuffer(o, "<i4")
                trees.append((order, CoverTree(p[order], np.frombuffer(t, _NODE))))
            yield row, points, trees


def _round(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; entries that no part is nearest to stay."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [np.zeros(b.shape, np.int64) for b in books], [np.zeros(len(b), np.int64) for b in books]
        for _, _, own in _blocks(batches, len(books)):
            for k, (_, tree) in enumerate(own):
                s, c = tree.totals(books[k])
                sums[k] += s
                counts[k] += c
        for k, (s, c) in enumerate(zip(sums, counts, strict=True)):
            used = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)), pa.array(np.column_stack([c[used], s[used]]).tolist(), pa.list_(pa.int64()))],
                names=["part", "entry", "totals"],
            )

    tasks = trees.select("n", "points", "orders", "nodes").mapInArrow(run, "part int, entry int, totals array<bigint>")
    cells = tasks.select("part", "entry", F.posexplode("totals").alias("cell", "v")).groupBy("part", "entry", "cell").agg(F.sum("v").alias("v"))
    found = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
    for r in cells.collect():  # as many numbers as the codebooks have
        found[r.part][r.entry, r.cell] = r.v
    return [np.where(f[:, :1] > 0, np.floor_divide(f[:, 1:], np.maximum(f[:, :1], 1)), b) for f, b in zip(found, books, strict=True)]


def _encode(trees: DataFrame, books: list[np.ndarray], label: str) -> DataFrame:
    """id, label, code (an array, one index for each part), error of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, points, own in _blocks(batches, len(books)):
            codes = np.empty((len(points), len(books)), np.int32)
            error = np.zeros(len(points), np.int64)
            for k, (order, tree) in enumerate(own):
                nearest = tree.codes(books[k])
                codes[order, k] = nearest
                error[order] += ((tree.points - books[k][nearest]) ** 2).sum(axis=1)
            arrays = [row.column("ids").flatten(), row.column("labels").flatten(), pa.array(codes.tolist(), pa.list_(pa.int32())), pa.array(error)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "label", "code", "error"])

    return trees.mapInArrow(run, f"id bigint, label {label}, code array<int>, error bigint")


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, scale: float) -> DataFrame:
    """id, label, components (floor(scale * x)) of the rows whose vector is there with finite components only."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(vector_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), vector.alias("vector"), finite.alias("finite")
    )
    return rows.where("finite").select("id", "label", F.transform("vector", lambda x: F.floor(F.lit(scale) * x)).alias("components"))


def compress_vectors(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4
) -> tuple[DataFrame, list[np.ndarray]]:
    """id, label, code, error of every row of ``vectors`` (as ``usable`` gives them), and the final codebook of each part.

    Vectors are cut into equal consecutive parts; where lengths differ or don't divide, zeros follow. Codebooks start
    with the parts of the ``entries`` smallest ids (null ids last, rows of one id by their components) and have fewer
    entries where there are fewer rows. Repeated rows are rows of their own; an empty table gives no rows and empty
    codebooks. Components and errors have to fit 64 bits. The driver sees the first rows and the codebooks.
    """
    label = vectors.schema["label"].dataType.simpleString()
    longest = vectors.agg(F.max(F.size("components"))).first()[0] or 0
    width = -(-longest // parts) * parts
    trees = plant_trees(vectors, width, parts)
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "components").limit(entries).select("components").collect()
    start = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        start[i, : len(r.components)] = r.components
    books = _parts(start, parts)
    if len(first):
        for _ in range(rounds):
            books = _round(trees, books)
    return _encode(trees, books, label), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def _sql(rounds: int = 4) -> str:
    """Lloyd's rounds one by one; a key of distance and index picks the nearest entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rn, p.part, min(CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(p.s, c.s)]) AS BIGINT) * 256 + c.entry) AS k
  FROM p JOIN c{r} c ON p.part = c.part GROUP BY rn, p.part)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.s, c.s) AS s FROM c{r} c LEFT JOIN (
  SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS s FROM (
    SELECT p.part, a.k % 256 AS entry, i, CAST(sum(p.s[i]) AS DOUBLE) AS total, count(*) AS n
    FROM p JOIN a{r} a ON p.rn = a.rn AND p.part = a.part, (SELECT unnest(range(1, 257)) AS i) WHERE i <= len(p.s) GROUP BY 1, 2, 3) GROUP BY 1, 2) m
  ON c.part = m.part AND c.entry = m.entry)""")
    return f"""
WITH v AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS rn FROM (
  SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)),
p AS MATERIALIZED (SELECT rn, part, e[part * (len(e) // 4) + 1 : (part + 1) * (len(e) // 4)] AS s FROM v, (SELECT unnest(range(0, 4)) AS part)),
c0 AS MATERIALIZED (SELECT part, rn - 1 AS entry, s FROM p WHERE rn <= 256),
{", ".join(steps)},
d AS (SELECT rn, string_agg(printf('%02x', k % 256), '' ORDER BY part) AS code, CAST(sum(k // 256) AS BIGINT) AS error FROM a{rounds} GROUP BY rn)
SELECT v.vec_id, d.code, d.error, CAST(sum(d.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM v JOIN d ON v.rn = d.rn
"""


@query("op11_cover_tree_codes", _sql())
def op11_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 1024.0)
    rows, books = compress_vectors(given)
    rows = written(rows, "vector-codes")
    by_label = rows.groupBy(F.col("label").alias("own_label")).agg(F.sum("error").alias("label_error"))
    hexes = F.array_join(F.transform("code", lambda i: F.lower(F.lpad(F.hex(i), 2, "0"))), "")
    joined = rows.join(by_label, F.col("label").eqNullSafe(F.col("own_label")))
    return joined.select(
        F.col("id").alias("vec_id"), hexes.alias("code"), "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256")
    )
