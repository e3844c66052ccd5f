"""Exact top-k inner products by aggregation of sorted lists without random access.

The vectors of a block have one list per component, sorted by value, which all queries share. Lists are
read from both ends, to a depth that doubles; each query uses of each list the end that its own sign
favours. What was read gives every vector a lower and an upper bound: a component not yet read is at least
the list's far end and at most the last entry read. A query stops when few vectors have an upper bound that
reaches its k-th best lower bound, among them any that no list has shown yet; the scores of these are
resolved. The entries read so far stand in matrices, so all queries of a block are bounded together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylake.llm.common import table, written
from tallylake.llm.registry import query

#: Vectors and queries that one task compares; both are dealt by a hash of their ids.
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 1024
#: The first reading takes one entry of so many from each end of a list; each further one doubles it.
FIRST_READING = 8
#: Reading stops when one vector of so many is left.
RESOLVE_PART = 32
#: Scores below this are exact in double precision.
EXACT = float(1 << 50)
SCALE = 256.0


class Lists:
    """Vectors of a block (rows, whole numbers as doubles) with a sorted list for each component.

    Rows of one id are told apart by ``keys``; without them ids are unique.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, keys: np.ndarray | None = None):
        self.vectors, self.ids, self.keys = vectors, ids, ids if keys is None else keys
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def _read(self, depth: int, top: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``depth`` entries from one end of each list show: the last value, and for each vector how far its
        entries that were read lie beyond the last value, and from the list's far end; 0 for others."""
        part = slice(len(self.ids) - depth, None) if top else slice(0, depth)
        rows, values = self.order[part], self.sorted[part]
        last, far = (values[0], self.sorted[0]) if top else (values[-1], self.sorted[-1])
        beyond, from_far = np.zeros_like(self.vectors), np.zeros_like(self.vectors)
        np.put_along_axis(beyond, rows, np.abs(values - last), axis=0)
        np.put_along_axis(from_far, rows, np.abs(values - far), axis=0)
        return last, beyond, from_far

    def bounds(self, weights: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Upper and lower bounds of the scores of all vectors (rows) with all queries (columns)."""
        plus, minus = np.maximum(weights, 0).T, np.maximum(-weights, 0).T
        top, above, above_far = self._read(depth, True)
        bottom, below, below_far = self._read(depth, False)
        upper = top @ plus - bottom @ minus + above @ plus + below @ minus
        lower = self.sorted[0] @ plus - self.sorted[-1] @ minus + above_far @ plus + below_far @ minus
        return upper, lower

    def _rank(self, rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        scores = self.vectors[rows] @ weights
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best].tolist(), scores[best].astype(np.int64).tolist()

    def best(self, query_keys: np.ndarray, weights: np.ndarray, k: int) -> dict[int, tuple[list[int], list[int]]]:
        """By query (row of ``weights``): ids and scores of the k best other vectors, the smaller id first among equals."""
        n, found = len(self.ids), {}
        exact = np.abs(weights) @ np.abs(self.vectors).max(axis=0, initial=0) < EXACT
        for q in np.flatnonzero(~exact).tolist():
            found[q] = self._best_of_whole_numbers(int(query_keys[q]), weights[q], k)
        open_queries, depth = np.flatnonzero(exact), -(-n // FIRST_READING)
        while len(open_queries):
            upper, lower = self.bounds(weights[open_queries], depth)
            own = self.keys[:, None] == query_keys[open_queries]
            lower[own] = upper[own] = -np.inf
            reach = np.partition(lower, n - k, axis=0)[n - k] if n > k else np.full(len(open_queries), -np.inf)
            left = (upper >= reach) & ~own
            done = (left.sum(axis=0) <= max(k, n // RESOLVE_PART)) | (depth >= n)
            for at in np.flatnonzero(done).tolist():
                q = int(open_queries[at])
                found[q] = self._rank(np.flatnonzero(left[:, at]), weights[q], k)
            open_queries, depth = open_queries[~done], min(n, 2 * depth)
        return found

    def _best_of_whole_numbers(self, query_key: int, weights: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        """Beyond double precision bounds would not be sure; whole numbers of any size are."""
        whole = [int(x) for x in weights]
        every = sorted(
            (-sum(int(x) * w for x, w in zip(v, whole, strict=True)), int(i))
            for v, i, key in zip(self.vectors, self.ids, self.keys, strict=True) if key != query_key
        )[:k]
        return [i for _, i in every], [-s for s, _ in every]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of ``width``, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width))
    for i, vector in enumerate(column.to_pylist()):
        out[i, : len(vector)] = vector
    return np.floor(out * SCALE)


_BEST = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _compare(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return _BEST.empty_table()
        width = max(len(v) for t in (queries, vectors) for v in t["vector"].to_pylist())
        lists = Lists(_matrix(vectors["vector"], width), vectors["id"].to_numpy(), vectors["row"].to_numpy())
        query_ids, query_rows = queries["id"].to_numpy(), queries["row"].to_numpy()
        found: tuple[list, list, list, list] = ([], [], [], [])
        for q, (ids, scores) in lists.best(query_rows, _matrix(queries["vector"], width), k).items():
            found[0].extend([int(query_ids[q])] * len(ids))
            found[1].extend([int(query_rows[q])] * len(ids))
            found[2].extend(ids)
            found[3].extend(scores)
        return pa.table([pa.array(c, pa.int64()) for c in found], schema=_BEST)

    return run


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, row (a number of its own for each row), vector (doubles): rows with an id and a vector of finite components."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull())
    rows = rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector"), finite.alias("finite")).where("finite")
    return rows.select("id", F.monotonically_increasing_id().alias("row"), "vector")


def top_k(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k vectors of largest inner product, other than its own row.

    Both inputs come from ``usable``, written once. Rows of one id are queries and candidates of their own. Components are floor(256 * x). Equal scores go to the smaller
    id; a query with fewer than k others gets all of them. Vectors of different lengths are compared
    as if zeros followed the shorter one. Scores have to fit 64 bits. Without queries or vectors
    there are no rows. Each pair of a query block and a vector block is one group.
    """
    n, q = vectors.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-q // BLOCK_QUERIES))
    own = vectors.select("id", "row", "vector", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"))
    own = own.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    asked = queries.select("id", "row", "vector", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int").alias("query_block"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["block", "query_block"]
    pairs = asked.groupBy(*keys).cogroup(own.groupBy(*keys))
    found = pairs.applyInArrow(_compare(k), "query_id long, query_row long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: A query of ``op9`` is every vector whose id is divisible by this.
QUERY_STEP, BEST = 50, 5
SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rn, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, q.rn, c.vec_id AS vec_id,
  CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rn <> c.rn WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op9_exact_topk", SQL)
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = written(usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vectors")
    return top_k(vectors.where(F.col("id") % QUERY_STEP == 0), vectors, BEST)
