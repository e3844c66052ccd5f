import math
import random

from compare import difference

from tallylake.llm import topk
from tallylake.llm.queries import ORACLES
from tallylake.llm.topk import op9_exact_topk, top_k, usable

KINDS = "vec_id long, embedding array<double>, score string"


def brute(vectors, k):
    v = {i: [math.floor(256 * x) for x in e] for i, e in vectors}
    out = {}
    for q in v:
        ranked = sorted((-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q)[:k]
        out |= {(q, r + 1): (c, -s) for r, (s, c) in enumerate(ranked)}
    return out


def test_the_query_equals_its_sql(spark):
    assert difference(spark, "/root/testdata/sf0.001", lambda s, d: op9_exact_topk(s, d).withColumn("rank", topk.F.col("rank")), ORACLES["op9_exact_topk"])[0] is None


def test_ties_blocks_and_signs(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 30)
    random.seed(2)
    rows = [(i, [random.choice([-1.0, -0.3, 0.0, 0.25, 1.5]) for _ in range(6)]) for i in range(-60, 60)]
    frame = spark.createDataFrame([(i, e, "x") for i, e in rows], KINDS)
    vectors = usable(frame, "vec_id", "embedding")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k(vectors, vectors, 4).collect()}
    assert got == brute(rows, 4)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (7, [-1.0, 0.5]), (100, [1e6, 1e6]), (3, [0.5]), (9, [])]
    bad = [(1, None), (2, [1.0, None]), (4, [inf, 1.0]), (5, [nan, 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame([(i, e, "x") for i, e in good + bad], KINDS)
    vectors = usable(frame, "vec_id", "embedding")
    queries = vectors.where("id % 50 = 0")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k(queries, vectors, 5).collect()}
    assert got == {k: v for k, v in brute(good, 5).items() if k[0] % 50 == 0} and len(got) == 15
    assert top_k(queries.limit(0), vectors, 5).count() == 0 and top_k(queries, vectors.limit(0), 5).count() == 0


def test_bounds_hold_at_every_depth():
    random.seed(5)
    lists = topk.Lists(topk.np.array([[random.randint(-9, 9) for _ in range(5)] for _ in range(40)], float), topk.np.arange(40))
    weights = topk.np.array([[random.randint(-4, 4) for _ in range(5)] for _ in range(12)], float)
    scores = lists.vectors @ weights.T
    for depth in range(1, 41):
        upper, lower = lists.bounds(weights, depth)
        assert (lower <= scores).all() and (scores <= upper).all()
    assert (upper == scores).all() and (lower == scores).all()


def test_scores_beyond_double_precision(spark):
    rows = [(0, [3e5, 1.0]), (1, [300000.01, 2.0]), (2, [1e5, -1e11])]
    vectors = usable(spark.createDataFrame([(i, e, "x") for i, e in rows[:2]], KINDS), "vec_id", "embedding")
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k(vectors, vectors, 1).collect()} == brute(rows[:2], 1)
    large = topk.Lists(topk.np.floor(topk.np.array([r[1] for r in rows]) * 256), topk.np.arange(3))
    assert large.best(large.ids[2:], large.vectors[2:], 1)[0][1] == [brute(rows, 1)[2, 1][1]]


def test_rows_of_one_id_are_queries_and_candidates_of_their_own(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, -1.0]), (50, [2.0, 0.0]), (7, [1.0, 1.0])]
    vectors = topk.written(usable(spark.createDataFrame([(i, e, "x") for i, e in rows], KINDS), "vec_id", "embedding"), "vectors")
    got = sorted(tuple(r) for r in top_k(vectors.where("id % 50 = 0"), vectors, 3).collect())
    expected = []
    for at, (q, v) in enumerate(rows):
        if q % 50 == 0:
            scores = sorted((-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)), c) for n, (c, w) in enumerate(rows) if n != at)
            expected += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:3], 1)]
    assert got == sorted(expected) and len(got) == 12
