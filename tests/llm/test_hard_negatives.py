"""Hard negatives against all inner products, and the tree's invariants."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from horizonkit.llm import hard_negatives as hn
from horizonkit.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, shard int, score double"


def brute(rows, is_anchor=lambda i: i % 100 == 0, k=10, positives=5):
    """``rows``: (vec_id, vector, label)."""
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    once = {}
    for i, v, l in fine:
        once[i] = min(once.get(i, (l, v)), (l, v))
    out = []
    for a, (la, va) in once.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, l) for i, (l, v) in once.items() if i != a and len(v) == len(va))
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            s = -s
            fit = [x for x in scored if x[2] != la and 30 * s <= -100 * x[0] <= 90 * s][:k]
            out += [(a, p, r + 1, i, s, -t) for r, (t, i, _) in enumerate(fit)]
    return sorted(out)


def points(r, kind, n, dim):
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    for i in range(n):
        if kind == "spread":
            yield i, [r.gauss(0, .3) for _ in range(dim)], r.randrange(4)
        elif kind == "groups":
            c = r.randrange(6)
            yield i, [x + r.gauss(0, .1) for x in centres[c]], c % 3
        elif kind == "ties":  # few different vectors, a third of the rows one of them
            yield i, [float(r.randrange(3)) for _ in range(dim)] if r.random() < .6 else [1.0] * dim, r.randrange(3)
        else:  # one label with nearly all rows, norms of every size
            s = 10 ** r.uniform(-3, 2)
            yield i, [s * r.gauss(0, 1) for _ in range(dim)], 0 if r.random() < .9 else r.randrange(50)


@pytest.mark.parametrize("kind", ["spread", "groups", "ties", "norms"])
def test_equals_brute_force(spark, monkeypatch, kind):
    r = random.Random(kind)
    monkeypatch.setattr(hn, "SHARD_ROWS", 150)
    for dim in (2, 16):
        rows = list(points(r, kind, 900, dim))
        df = spark.createDataFrame([(i, v, l, "x", 1, 0.5) for i, v, l in rows], SCHEMA)
        out = hn.hard_negatives(df, F.col("vec_id") % 100 == 0)
        assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        got = sorted(map(tuple, out.collect()))
        assert got == brute(rows) and (got or kind == "norms")


@pytest.mark.parametrize("kind", ["spread", "groups", "ties", "norms"])
def test_tree(kind):
    """Radii cover, centres are apart, searches equal all products."""
    r = random.Random(3)
    rows = list(points(r, kind, 1500, 8))
    x = np.floor(256 * np.array([v for _, v, _ in rows]))
    labels = np.array([l for _, _, l in rows])
    ids = np.array([i for i, _, _ in rows])
    tree = hn.CoverTree(x, ids, labels, leaf=16)
    todo, seen = [tree.root], 0
    while todo:
        node = todo.pop()
        if node.nodes is None:
            continue
        seen += 1
        below = {c: n.points for c, n in node.nodes.items()}
        below |= {c: node.small[node.owner == c] for c in set(node.owner.tolist())}
        assert sorted(np.concatenate(list(below.values()))) == sorted(node.points)
        for c, p in below.items():
            angle = np.arccos(np.clip(tree.augmented[p] @ node.centres[c] / tree.norm ** 2, -1, 1))
            assert angle.max() <= np.arctan2(node.sin[c], node.cos[c]) + 1e-6
        todo += node.nodes.values()
    assert seen or kind == "ties"
    visited = []
    verify = tree._verify
    tree._verify = lambda *a: (visited.append(len(a[-1])), verify(*a))
    for i in range(0, 1500, 37):
        s = (x @ x[i]).astype(int)
        for same in (True, False):
            low, high = np.array([-(1 << 62), 0, 50_000]), np.array([1 << 62, 40_000, 60_000])
            got = tree.search(x[i], i, labels[i], same, low, high, 7)
            for w in range(3):
                fit = [j for j in range(1500) if j != i and (labels[j] == labels[i]) == same and low[w] <= s[j] <= high[w]]
                assert got[w] == sorted(((s[j], j) for j in fit), key=lambda t: (-t[0], t[1]))[:7]
    if kind == "groups":
        assert sum(visited) < 0.8 * 1500 * 2 * len(range(0, 1500, 37))


def test_odd_rows(spark):
    big = 3.0e12
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [5.0, 2.0], 1), (100, [-1.0, -2.0], 1), (1, [1.0, 1.0], 1), (2, [2.0, 1.0], 2), (3, [0.5, 0.5], 2),
            (4, None, 1), (5, [], 1), (6, [None, 1.0], 2), (7, [float("nan"), 1.0], 2), (8, [float("inf"), 1.0], 2), (9, [1.0, 1.0], None),
            (None, [1.0, 1.0], 1), (10, [1.0, 1.0, 1.0], 1), (11, [0.0, 0.0], 2), (200, [0.0, 0.0], 2), (300, [1.0, 1.0, 1.0], 7), (12, [0.5, 0.5], 2), (-100, [1.0, 0.5], 2)]
    df = lambda rows: spark.createDataFrame([(i, v, l, "x", 1, 0.5) for i, v, l in rows], SCHEMA)
    got = sorted(map(tuple, hn.hard_negatives(df(rows), F.col("vec_id") % 100 == 0).collect()))
    assert got == brute(rows) and len(got) > 5
    assert hn.hard_negatives(df([]), F.col("vec_id") % 100 == 0).collect() == []
    wide = [(0, [big, 1.0], 1), (1, [16.0, 1.0], 1), (2, [15.0, 3.0], 2), (3, [10.0, 3.0], 2)]  # products beyond 2**53
    got = sorted(map(tuple, hn.hard_negatives(df(wide), F.col("vec_id") == 0).collect()))
    assert got == brute(wide, lambda i: i == 0) and got[0][4] > 1 << 53


def test_query(spark, tmp_path):
    r = random.Random(6)
    rows = [(i, [r.gauss(0, .2) for _ in range(12)], r.randrange(10) if r.random() < .97 else None) for i in range(700)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = brute([(i, v, (l + 1) % 10 if l is not None and i % 7 == 0 else l) for i, v, l in rows])
    assert sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, str(tmp_path)).collect())) == want and len(want) > 100
