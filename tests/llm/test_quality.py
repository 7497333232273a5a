"""Quality classifier: held-out accuracy, site priors against their formula, odd inputs."""
import random

import pytest

from horizonkit.llm.quality import _strength, classify, site_priors

WORDS = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)]


def document(r, low, toxic):
    w = [r.choice(WORDS) for _ in range(r.randrange(20, 200))]
    if low:
        w = [x + r.choice(["***", "%%%", "$$$"]) for x in w] if r.random() < .5 else [x for x in w[:20] for _ in range(9)]
    if toxic:
        for _ in range(2):
            w.insert(r.randrange(len(w)), r.choice(["badone", "badtwo", "Badthree!"]))
    return " ".join(w)


@pytest.fixture
def frames(spark):
    def make(rows, labels):
        docs = spark.createDataFrame([(i, t, s, g, 0.5) for i, t, s, g in rows], "doc_id bigint, text string, source string, lang string, low double")
        return docs, spark.createDataFrame([(*x, "h") for x in labels], "doc_id bigint, quality int, toxic int, host string")
    return make


def test_held_out_accuracy_and_copies(frames):
    r = random.Random(1)
    truth = {i: (r.random() < .2, r.random() < .15) for i in range(1500)}
    rows = [(i, document(r, *truth[i]), f"s{i % 7}", "en") for i in truth]
    copy = document(r, False, False)
    rows += [(5000 + i, copy, "s1", "en") for i in range(300)]  # many copies of one clean text
    labels = [(i, 1 - truth[i][0], int(truth[i][1])) for i in range(0, 1500, 2)] + [(5000 + i, 1, 0) for i in range(300)]
    got = {x.doc_id: x for x in classify(*frames(rows, labels)).collect()}
    assert len(got) == 1800
    held = [i for i in range(1, 1500, 2)]
    right = sum((got[i].toxic > 0.5) == truth[i][1] and (got[i].low > 0.5) == truth[i][0] for i in held)
    assert right >= 0.97 * len(held)
    clean = [i for i in held if not any(truth[i])] + [5000 + i for i in range(300)]
    assert sum(got[i].kept for i in clean) >= 0.99 * len(clean)


def test_site_priors_follow_the_formula(spark):
    r = random.Random(2)
    rows = [(f"h{k % 9}", f"p{k % 2}", int(r.random() < (0.7 if k % 9 < 3 else 0.1))) for k in range(900)] + [("rare", "p0", 1)]
    known = spark.createDataFrame(rows, "host string, path string, is_low int")
    overall = sum(y for _, _, y in rows) / len(rows)

    def units(key, mean):
        out = {}
        for h, p, y in rows:
            n, k = out.get(key(h, p), (0, 0))
            out[key(h, p)] = (n + 1, k + y)
        return {u: (n, k, mean(u)) for u, (n, k) in out.items()}

    def weight(x):
        total, h = sum(n for n, _, _ in x.values()), len(x)
        s = sum(n * (k / n - m) ** 2 / (m * (1 - m)) for n, k, m in x.values())
        rho = (s - (h - 1)) / (total - sum(n * n for n, _, _ in x.values()) / total - (h - 1))
        rho = min(0.9, max(1e-4, rho))
        return (1 - rho) / rho

    hosts = units(lambda h, p: h, lambda u: overall)
    w = weight(hosts)
    want = {u: (k + w * overall) / (n + w) for u, (n, k, _) in hosts.items()}
    a, b = site_priors(known, "low", overall)
    got = {x.host: x.prior for x in a.collect()}
    assert got == pytest.approx(want)
    assert abs(got["rare"] - overall) < abs(1 - overall) / 1.2  # one label moves a site little
    paths = units(lambda h, p: (h, p), lambda u: want[u[0]])
    w = weight(paths)
    assert {(x.host, x.path): x.prior for x in b.collect()} == pytest.approx({u: (k + w * m) / (n + w) for u, (n, k, m) in paths.items()})


def test_odd_rows(frames):
    rows = [(1, None, None, None), (2, "", "s", None), (3, "text " * 30_000, "s", "en"), (None, "no id", "s", "en"), (4, "a b", "s", "en"), (4, "a b", "s", "en")]
    docs, labels = frames(rows, [(1, None, 1), (1, 0, None), (4, 1, 0), (None, 0, 1), (77, 0, 1)])
    got = classify(docs, labels).collect()
    assert sorted((x.doc_id or -1) for x in got) == [-1, 1, 2, 3, 4, 4]
    assert all(x.low_evidence == 0 == x.toxic_evidence and 0 < x.low < 1 for x in got)
    docs, labels = frames(rows, [])
    assert [x.kept for x in classify(docs, labels).collect()] == [True] * 6
    docs, labels = frames([], [(1, 0, 1)])
    assert classify(docs, labels).collect() == []
    assert _strength(docs.selectExpr("1 as n", "1 as k", "0.5 as m")) == 1e4
