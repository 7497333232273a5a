"""Quality rules: counts, votes and expectation-maximisation against plain Python, and odd rows."""
import math
import random
import re
import unicodedata

import pytest

from horizonkit.llm import quality_rules as q
from horizonkit.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    t = text or ""
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i:i + 8]), []).append(i)
    again = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    kind = [unicodedata.category(c) for c in t]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_letters": sum(k[0] == "L" for k in kind), "n_capitals": kind.count("Lu"),
            "n_bare": sum(not any(unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd" for c in x) for x in w),
            "n_stops": sum(any(c in ".!?" for c in x) for x in w), "n_distinct": len(set(w)), "n_repeat_words": len(again)}


def voted(m):
    python = lambda rule: rule.replace(" = ", " == ")
    return "".join("-" if eval(python(bad), {}, m) else "+" if eval(python(good), {}, m) else "0" for bad, good in q.RULES.values())


def fitted(votes, rounds=q.ROUNDS):
    """Posterior per vote pattern."""
    n = len(q.RULES)
    share, good, bad = q.SHARE, [q.GOOD_IF_GOOD] * n, [q.GOOD_IF_BAD] * n
    for k in range(rounds + 1):
        post = {}
        for v in set(votes):
            a, b = share, 1 - share
            for r, s in enumerate(v):
                a *= {"+": good[r], "-": 1 - good[r], "0": 1}[s]
                b *= {"+": bad[r], "-": 1 - bad[r], "0": 1}[s]
            post[v] = a / (a + b)
        if k == rounds:
            return post
        p = [post[v] for v in votes]
        share = (sum(p) + q.STRENGTH * q.SHARE) / (len(p) + q.STRENGTH)
        for r in range(n):
            on = [(x, v[r]) for x, v in zip(p, votes) if v[r] != "0"]
            good[r] = (sum(x for x, s in on if s == "+") + q.STRENGTH * q.GOOD_IF_GOOD) / (sum(x for x, _ in on) + q.STRENGTH)
            bad[r] = (sum(1 - x for x, s in on if s == "+") + q.STRENGTH * q.GOOD_IF_BAD) / (sum(1 - x for x, _ in on) + q.STRENGTH)


def texts(r, n):
    word = lambda: r.choice(["tree", "Haus", "été", "and", "of", "Ω", "x1", "42", "–", "lamp.", "why?", "long" * 4])
    for k in range(n):
        w = [word() + str(r.randrange(300)) * (r.random() < .5) for _ in range(r.randrange(0, 160))]
        kind = k % 6
        if kind == 1:
            w = [x + r.choice(["%%%", "***"]) for x in w]
        if kind == 2:
            w = [x.upper() + "!!" for x in w]
        if kind == 3:
            w = w[:12] * r.randrange(1, 9)
        if kind == 4:
            w = [y for x in w for y in (x, "|")]
        lines = [" ".join(w[i:i + 9]) for i in range(0, len(w), 9)]
        yield "\n".join(lines + lines[:3] * (r.random() < .2))


@pytest.fixture
def rows():
    r = random.Random(5)
    out = list(enumerate(texts(r, 400)))
    return out + [(1000, None), (1001, ""), (1002, " \t\x0b\x0c\r\n\n"), (1003, "a b c d e f g h " * 2), (1004, "a " * 9), (None, "no id here"), (7, "twice 𝔘\nTwice"), (7, "twice 𝔘\nTwice"),
                  (1005, "lorem ipsum dolor " * 20_000), (1006, "x" * 300_000), (1007, "same\nsame\n same\n\n\n")]


def test_equals_plain_python(spark, docs_of, rows):
    want = [(i, counted(t)) for i, t in rows]
    post = fitted([voted(m) for _, m in want])
    key = lambda x: str((x[0], sorted(x[1].items())))
    out = q.judge(docs_of(rows)).collect()
    got = [(x.doc_id, {n: x[n] for n in want[0][1]}) for x in out]
    assert sorted(got, key=key) == sorted(want, key=key)
    for x in out:
        assert x.votes == voted({n: x[n] for n in want[0][1]})
        assert x.posterior == pytest.approx(post[x.votes], abs=1e-9) and x.good == (x.posterior >= 0.5)
    assert 100 < sum(x.good for x in out) < 350


def test_learns_whom_to_trust(spark):
    """Of ten rules, nine are right in 95 % and the last votes at random: it gets no weight."""
    r = random.Random(2)
    patterns, truth = {}, []
    for _ in range(4000):
        good = r.random() < 0.7
        v = "".join(("+" if (r.random() < .95) == good else "-") if r.random() < .8 else "0" for _ in range(9)) + r.choice("+-")
        patterns[v] = patterns.get(v, 0) + 1
        truth.append((v, good))
    logs = q.fit(spark.createDataFrame(list(patterns.items()), "votes string, n bigint"))
    assert all(logs[1 + 2 * k] > 2 and logs[2 + 2 * k] < -2 for k in range(9))
    assert abs(logs[19]) < 0.15 and abs(logs[20]) < 0.15
    odds = lambda v: logs[0] + sum({"+": logs[1 + 2 * k], "-": logs[2 + 2 * k], "0": 0}[s] for k, s in enumerate(v))
    assert sum((odds(v) > 0) == good for v, good in truth) > 0.99 * len(truth)
    assert 0.65 < 1 / (1 + math.exp(-logs[0])) < 0.75


def test_query_and_empty(spark, tmp_path, docs_of, rows):
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op12_quality_rules"](spark, str(tmp_path))
    assert out.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.base_failed == (x.n_words < 20 or 100 * x.n_repeat_words > 30 * x.n_words)
        assert x.kept == (not x.base_failed and x.posterior >= 0.5)
    assert q.judge(docs_of([])).collect() == []
