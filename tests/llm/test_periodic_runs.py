"""Periodic runs against a quadratic search, over alphabets and shapes that repeat at every scale."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from horizonkit.llm.periodic_runs import find_runs, periodic_runs
from horizonkit.llm.queries import QUERIES, planted_runs


def brute(words, least=12):
    """(start, end, period): every lag's longest stretches, each under its smallest period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b, q) for (a, b), q in out.items())


def shape(r, n):
    k, kind = r.choice([1, 2, 2, 3, 5, 50]), r.randrange(6)
    letters = lambda m: [r.randrange(k) for _ in range(m)]
    if kind == 0:
        return letters(n)
    if kind == 1:  # one period
        b = letters(r.randrange(1, max(2, n // 2)))
        return (b * n)[:n]
    if kind == 2:  # Fibonacci word
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 3:  # short periods beside each other
        out = []
        while len(out) < n:
            out += letters(r.randrange(1, 6)) * r.randrange(1, 30) + letters(r.randrange(2))
        return out[:n]
    if kind == 4:  # seams: one short period, out of phase
        m = r.randrange(3, 30)
        return ([0, 0, 1] * m + [0]) * r.randrange(2, 5)
    out = letters(3)  # periods within periods
    while len(out) < n:
        out = out * r.randrange(2, 4) + letters(1) * r.randrange(3)
    return out[:n]


@pytest.mark.parametrize("least,direct", [(12, 48), (4, 16), (3, 8)])
def test_equals_brute_force(least, direct):
    seen = 0
    for seed in range(150):
        r = random.Random(seed)
        texts = sorted((shape(r, r.randrange(1, 400)) for _ in range(r.randrange(1, 4))), key=len, reverse=True)
        x = np.array([v for k, t in enumerate(texts) for v in [*t, -1 - k]], np.int32)
        want, at = [], 0
        for t in texts:
            want += [(a + at, b + at, q) for a, b, q in brute(t, least)]
            at += len(t) + 1
        got = find_runs(x, np.array([len(t) for t in texts]), least, direct)
        assert got == sorted(want), (seed, texts)
        seen += len(want)
    assert seen > 3000


def test_long_texts_stay_cheap():
    """One word, one seam and one long period in 200,000 words each: the known runs only."""
    n = 200_000
    same = np.zeros(n, np.int32)
    seam = np.array(([0, 0, 1] * (n // 6) + [0]) * 2, np.int32)
    period = np.tile(np.random.default_rng(1).integers(0, 1000, n // 4), 4).astype(np.int32)
    for x in (same, period):
        assert find_runs(np.append(x, -1).astype(np.int32), np.array([n])) == [(0, n, 1 if x is same else n // 4)]
    runs = find_runs(np.append(seam, -1).astype(np.int32), np.array([len(seam)]))
    assert (0, len(seam), len(seam) // 2) in runs and len(runs) > n // 8


def expected(words):
    runs = sorted((a, b - a, q) for a, b, q in brute(words))
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def test_rows(spark, docs_of):
    r = random.Random(4)
    rows = [(i, "\t".join(f"w{v}" for v in shape(r, r.randrange(1, 300)))) for i in range(60)]
    rows += [(90, None), (91, ""), (92, " \n\x0b "), (93, "a " * 30), (93, "a " * 30), (None, "no id " * 9), (94, "é x y ü " * 14), (95, "one"), (96, "lorem ipsum " * 20_000)]
    got = periodic_runs(docs_of(rows)).collect()
    assert len(got) == len(rows)
    key = lambda x: (x[0] is None, x)
    want = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs, text = ([(0, 40_000, 2)], "lorem ipsum") if i == 96 else expected(w)
        want.append((i, len(w), runs, text))
    assert sorted([(x.doc_id, x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in got], key=key) == sorted(want, key=key)
    assert periodic_runs(docs_of([])).collect() == []


def test_query(spark, tmp_path):
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(r.randrange(0, 150)))) for i in range(200)] + [(777, None), (None, "x y"), (13, " "), (13, "a  a\n" * 20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want, planted = [], 0
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(str(i).encode()) if i is not None else 1, len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs, text = expected(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else None
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     sha("".join(f"{a},{b},{q}\n" for a, b, q in runs)), sha(text)))
    out = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert planted > 10 and sum(x[1] for x in want) > 10
    assert planted_runs(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
