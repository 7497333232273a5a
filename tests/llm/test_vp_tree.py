"""Vantage-point search against brute force: exact at factor 1, recall below."""
import numpy as np
import pytest

from horizonkit.llm.vp_tree import FACTOR, nearest

SF = "/root/testdata/sf0.01/embeddings.parquet"


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        d = sorted((float(np.sqrt(((np.array(x, float) - np.array(v, float)) ** 2).sum())), i) for i, x in rows if i != q and len(x) == len(v))
        out[q] = d[:k]
    return out


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame([(i, v, "s") for i, v in rows], "vec_id bigint, embedding array<double>, shard string")


def test_factor_one_is_exact_with_ties(frame):
    r = np.random.default_rng(1)
    rows = [(i, np.round(r.normal(size=5), 1).tolist()) for i in range(5000)]
    rows += [(5000 + i, [1.0, 0.5, 0.0, 0.0, 2.0]) for i in range(600)]  # many equal vectors
    queries = rows[::250] + rows[5000:5002]
    got = {}
    for x in nearest(frame(rows), frame(queries), k=7, factor=1.0).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.score, x.vec_id))
    want = brute(rows, queries, 7)
    for q, d in want.items():
        assert [(s, i) for _, s, i in sorted(got[q])] == d
        assert [n for n, _, _ in sorted(got[q])] == list(range(1, 8))


def test_recall_of_default_factor(spark):
    t = spark.read.parquet(SF)
    rows = [(r.vec_id, r.embedding) for r in t.collect()]
    want = brute(rows, [x for x in rows if x[0] % 10 == 0], 10)
    hit = sum((x.score, x.vec_id) in want[x.query_id] for x in nearest(t, t.where("vec_id % 10 = 0"), factor=FACTOR).collect())
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, None]), (8, []), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (10, [3.0, 0.0])]
    got = [(x.query_id, x["rank"], x.vec_id) for x in nearest(frame(rows), frame(rows), k=5).collect()]
    assert sorted(got) == [(1, 1, 2), (1, 2, 10), (2, 1, 1), (2, 2, 10), (10, 1, 1), (10, 2, 2)]
    assert nearest(frame([]), frame(rows)).collect() == [] and nearest(frame(rows), frame([])).collect() == []
