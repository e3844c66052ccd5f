import math
import random

import numpy as np
import pytest
from compare import difference

from tallylake.llm import covertree
from tallylake.llm.covertree import CoverTree, codebooks_sha256, compress_vectors, op11_cover_tree_codes, usable
from tallylake.llm.queries import ORACLES

KINDS = "vec_id long, embedding array<double>, label string, id string, code int"


def brute(rows, parts, entries, rounds):
    """Whole numbers and plain loops. rows: (id, label, components)."""
    width = -(-max((len(c) for *_, c in rows), default=0) // parts) * parts
    own = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    own = [(i, label, [*c, *[0] * (width - len(c))]) for i, label, c in own]
    w = width // parts
    cut = [[c[k * w : (k + 1) * w] for *_, c in own] for k in range(parts)]
    books = [[list(x) for x in column[:entries]] for column in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            found = [nearest(x, books[k])[1] for x in cut[k]]
            for i in range(len(books[k])):
                mine = [x for x, f in zip(cut[k], found, strict=True) if f == i]
                if mine:
                    books[k][i] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = []
    for at, (i, label, _) in enumerate(own):
        last = [nearest(cut[k][at], books[k]) for k in range(parts)]
        out.append((i, label, [x for _, x in last], sum(d for d, _ in last)))
    return sorted(out, key=repr), books


def frame(spark, rows):
    return usable(spark.createDataFrame([(i, e, label, "x", 1) for i, label, e in rows], KINDS), "vec_id", "embedding", "label", 1024.0)


def whole(rows):
    return [(i, label, [math.floor(1024 * x) for x in e]) for i, label, e in rows]


def check(spark, rows, **how):
    got, books = compress_vectors(frame(spark, rows), **how)
    expected, wanted = brute(whole(rows), how["parts"], how["entries"], how["rounds"])
    assert [b.tolist() for b in books] == wanted
    assert sorted(((r.id, r.label, list(r.code), r.error) for r in got.collect()), key=repr) == expected


def test_the_query_equals_its_sql(spark):
    assert difference(spark, "/root/testdata/sf0.001", op11_cover_tree_codes, ORACLES["op11_cover_tree_codes"])[0] is None


@pytest.mark.parametrize("block", [7, 4096])
def test_clusters_ties_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK_VECTORS", block)
    random.seed(block)
    rows = []
    for i in range(150):
        base = random.choice([-3.0, 0.0, 0.5, 8.0])
        rows.append((i, random.choice(["a", "b", None]), [base + random.choice([0.0, 0.001, 0.25]) for _ in range(8)]))
    rows += [(1000 + i, "hot", [0.5] * 8) for i in range(60)]  # one very common vector
    check(spark, rows, parts=4, entries=16, rounds=3)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(3, "a", [1.0, 2.0, 3.0]), (1, None, []), (1, "b", [0.5]), (1, "b", [0.5]), (None, "c", [-1.0, 4.0, 2.0, 9.0, 5.0]), (2, "a", [1e5, -3e5])]
    bad = [(5, "a", None), (6, "a", [1.0, None]), (7, "a", [inf]), (8, "a", [nan, 1.0])]
    got, _ = compress_vectors(frame(spark, good + bad), parts=2, entries=3, rounds=2)
    expected, _ = brute(whole(good), 2, 3, 2)
    assert sorted(((r.id, r.label, list(r.code), r.error) for r in got.collect()), key=repr) == expected
    nothing, books = compress_vectors(frame(spark, bad), parts=2, entries=3, rounds=2)
    assert nothing.count() == 0 and all(not len(b) for b in books) and len(codebooks_sha256(books)) == 64


def test_trees_cover_separate_and_nest():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(300, 3)) * 40, rng.normal(size=(300, 3)) * 4 + 500, np.zeros((50, 3))]).astype(np.int64)
    order, nodes = CoverTree.build(points)
    assert sorted(order.tolist()) == list(range(len(points)))
    own = points[order].astype(float)
    inner = 0
    for node in nodes:
        d = np.linalg.norm(own[node["start"] : node["end"]] - own[node["centre"]], axis=1)
        assert d.max() <= node["radius"] + 1e-9 and node["start"] <= node["centre"] < node["end"]
        children = nodes[node["first"] : node["last"]]
        if len(children):
            inner += 1
            scale = node["radius"] / covertree.SHRINK
            assert children["start"][0] == node["start"] and children["end"][-1] == node["end"]
            assert (children["start"][1:] == children["end"][:-1]).all() and (children["radius"] <= scale + 1e-9).all()
            centres = own[children["centre"]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)[np.triu_indices(len(centres), 1)]
            assert not len(apart) or apart.min() > scale - 1e-9
            assert (centres == own[node["centre"]]).all(axis=1).any()
    assert inner > 10


def test_whole_subtrees_are_assigned():
    """Far clusters need no comparison of their points."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-1_000_000, 1_000_000, (8, 4))
    points = (centres[rng.integers(0, 8, 2000)] + rng.integers(-50, 50, (2000, 4))).astype(np.int64)
    order, nodes = CoverTree.build(points)
    tree = CoverTree(points[order], nodes)
    entry, start, end, at, _ = tree.assign(centres)
    assert not len(at) and (end - start).sum() == 2000 and len(entry) < 50
    exact = ((points[order][:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (tree.codes(centres) == exact).all()
    sums, counts = tree.totals(centres)
    assert (counts == np.bincount(exact, minlength=8)).all()
    assert all((sums[k] == points[order][exact == k].sum(axis=0)).all() for k in range(8))
