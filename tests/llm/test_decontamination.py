"""Decontamination against a word-by-word version, re-parameterised questions, odd inputs."""
import random
import re

import pytest

from horizonkit.llm.decontamination import MIN_WINDOWS, MIN_WORDS, UNITS, WINDOW, contaminations

WORD = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]+")


@pytest.fixture
def run(spark, docs_of):
    def go(docs, items):
        bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, doc_id int")
        return {(r.doc_id, r.item_id): r for r in contaminations(docs_of(docs).repartition(3), bench).collect()}
    return go


def tokens(text):
    out, end, number = [], 0, False
    for m in WORD.finditer(text or ""):
        gap, w = text[end:m.start()], m.group()
        opens = end == 0 and not out or any(c in gap for c in "\n\r.!?:;\"")
        if w[0].isascii() and w[0].isdigit():
            kind = "#number"
        elif w.lower() in UNITS and number:
            kind = "#unit"
        elif ("A" <= w[0] <= "Z" or "À" <= w[0] <= "Þ") and not opens:
            kind = "#name"
        else:
            kind = w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w)
        out.append((kind, "".join(c.lower() if c.isascii() else c for c in w)))
        end, number = m.end(), kind == "#number"
    return out


def brute(docs, items):
    found = set()
    for d, text in docs:
        t = tokens(text)
        for i, item in items:
            q = tokens(item)
            n = min(WINDOW, len(q))
            if n < MIN_WORDS:
                continue
            windows = [k for k in range(len(q) - n + 1) if 2 * sum(not x.startswith("#") for x, _ in q[k:k + n]) >= n]
            for diagonal in range(-len(q), len(t)):
                hit = [k for k in windows if 0 <= k + diagonal and k + diagonal + n <= len(t)
                       and [x for x, _ in q[k:k + n]] == [x for x, _ in t[k + diagonal:k + diagonal + n]]]
                pairs = {(q[p][1], t[p + diagonal][1]) for k in hit for p in range(k, k + n) if q[p][0].startswith("#")}
                if hit and len(hit) >= min(MIN_WINDOWS, len(windows)) and len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs}):
                    found.add((d, i))
    return found


def test_equals_word_by_word_version(run):
    r = random.Random(8)
    plain = [f"v{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    pool = plain + ["Ann", "Bob", "Élan", "7", "12", "12", "kg", "miles"]
    items = [(i, " ".join(r.choice(pool) for _ in range(r.choice([2, 5, 6, 8, 14, 30])))) for i in range(25)]
    docs = []
    for d in range(120):
        w = [r.choice(pool) + r.choice(["", "", "", ".", ",", "\n"]) for _ in range(r.randrange(60))]
        if r.random() < 0.7:
            q = r.choice(items)[1].split(" ")
            if r.random() < 0.6:
                swap = {x: r.choice(pool) for x in ("Ann", "Bob", "7", "12")}
                q = [swap.get(x, x) if r.random() < 0.9 else x for x in q]
            q = q[r.randrange(3):] if r.random() < 0.4 else q
            k = r.randrange(len(w) + 1)
            w[k:k] = q
        docs.append((d, " ".join(w)))
    want = brute(docs, items)
    assert len(want) > 20
    assert set(run(docs, items)) == want


def test_reparameterised_and_inconsistent(run):
    item = "A train leaves London at 9 and drives 120 km to York. After 9 hours it has gone 120 km, so how fast was the train?"
    swap = item.replace("London", "Paris").replace("York", "Lyon").replace("9", "8").replace("120", "300")
    broken = item.replace("9", "8", 1).replace("London", "Paris")
    got = run([(1, "Intro text here. " + item + " More text."), (2, "x " + swap), (3, broken), (4, "A train leaves the town.")], [(10, item)])
    assert {k: v.kind for k, v in got.items()} == {(1, 10): "verbatim", (2, 10): "re-parameterised"}


def test_odd_rows(run):
    long = "filler words stand here " * 20_000
    q = "this question has exactly nine plain words in it"
    docs = [(1, None), (2, ""), (3, " \n"), (4, q), (4, q), (5, long + q), (None, q.upper()), (6, "1 2 3 4 5 6 7 8 9")]
    items = [(1, q), (1, q), (2, None), (3, ""), (4, "too short"), (5, "11 12 13 14 15 16 17 18 19"), (None, q)]
    assert set(run(docs, items)) == {(d, i) for d in (4, 5) for i in (1, None)}


def test_empty_tables(run):
    assert run([], [(1, "one two three four five six")]) == {}
    assert run([(1, "one two three four five six")], []) == {}
