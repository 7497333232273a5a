"""Katz model against a plain dictionary version, and its normalisation."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from horizonkit.llm import katz

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


class Plain:
    """Counts in dictionaries, probabilities by their definition."""

    def __init__(self, rows):
        self.uni, self.bi = Counter(), Counter()
        for i, t in rows:
            if not katz.held_out(i):
                s = self.tokens(t)
                self.uni.update(s)
                self.bi.update(zip(["<start>", *s], s))
        self.context = Counter()
        for (h, _), c in self.bi.items():
            self.context[h] += c
        self.d1, self.d2 = (katz.discounts(np.array([sum(c == r for c in x.values()) for r in range(1, 7)])) for x in (self.uni, self.bi))
        self.total = sum(self.uni.values())
        left = self.total - sum(self.d(self.d1, c) * c for c in self.uni.values())
        self.plus = 0 if left > 1e-9 else 1
        self.unseen = (left if left > 1e-9 else 1) / (self.total + self.plus)

    @staticmethod
    def d(d, c):
        return d[min(c, katz.MOST_DISCOUNTED + 1)]

    @staticmethod
    def tokens(t):
        return [*WORD.findall((t or "").translate(LOWER)), "<end>"]

    def p1(self, w):
        c = self.uni[w]
        return self.d(self.d1, c) * c / (self.total + self.plus) if c else self.unseen

    def p(self, w, h):
        after = {x: c for (g, x), c in self.bi.items() if g == h}
        if not after:
            return self.p1(w)
        left = sum(c * (1 - self.d(self.d2, c)) for c in after.values())
        total = sum(after.values()) + (0 if left > 0 else 1)
        if w in after:
            return self.d(self.d2, after[w]) * after[w] / total
        return (left or 1) / total / (1 - sum(self.p1(x) for x in after)) * self.p1(w)

    def score(self, t):
        s = self.tokens(t)
        return sum(math.log10(self.p(w, h)) for h, w in zip(["<start>", *s], s))

    def base(self, t):
        return sum(math.log10((self.uni[w] + 1) / (self.total + len(self.uni) + 1)) for w in self.tokens(t))


def corpus(seed, n=70, vocab=40):
    r = random.Random(seed)
    names = [f"w{k}" for k in range(vocab)]
    rows = [(i, " ".join(r.choice(names[:r.randrange(1, vocab)]).capitalize() for _ in range(r.randrange(30)))) for i in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, "the " * 400 + "new words here"), (None, "w1 w2 w1"), (5, rows[5][1])]


@pytest.mark.parametrize("seed,chunk", [(1, 150), (2, 10**6)])
def test_equals_plain_version(docs_of, monkeypatch, seed, chunk):
    monkeypatch.setattr(katz.chunks, "__defaults__", (chunk,))
    rows = corpus(seed)
    model = Plain(rows)
    got = katz.score(docs_of(rows).repartition(3)).collect()
    key = lambda i, n, s: (i is None, i or 0, n, round(s, 7))
    want = sorted(key(i, len(model.tokens(t)), model.score(t)) for i, t in rows)
    assert sorted(key(r.doc_id, r.n_tokens, r.score) for r in got) == want
    assert sorted(round(r.base_score, 7) for r in got) == sorted(round(model.base(t), 7) for _, t in rows)
    assert {r.train_tokens for r in got} == {model.total}
    assert {r.doc_id: r.held_out for r in got} == {i: katz.held_out(i) for i, _ in rows}
    known = Counter(sum(w in model.uni for w in model.tokens(t)) for _, t in rows)
    assert Counter(r.n_known for r in got) == known


def test_sums_to_one():
    model = Plain(corpus(3))
    for h in [*list(model.uni)[:15], "<start>", "never seen"]:
        assert abs(sum(model.p(w, h) for w in [*model.uni, "<unseen>"]) - 1) < 1e-9


def test_discounts_small():
    assert (katz.discounts(np.array([0, 0, 0, 0, 0, 0]))[1:6] < 1).all()
    d = katz.discounts(np.array([100, 40, 20, 12, 8, 6]))
    assert (d[1:6] > 0).all() and (d[1:6] < 1).all() and d[6] == 1


def test_pack_round_trip():
    for x in ([], [0], [0, 0], [5, 1 << 40, 3], [-1, 7]):
        assert katz.unpack(katz.pack(np.array(x, np.int64))).tolist() == x


def test_empty_table_and_no_training(docs_of):
    assert katz.score(docs_of([])).collect() == []
    held = next(i for i in range(100) if katz.held_out(i))
    r = katz.score(docs_of([(held, "a b")])).first()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3) and abs(r.score) < 1e-12
