"""Preference formatting against a plain loop and against the registered SQL."""
import random

import duckdb
import pytest

from horizonkit.llm.chat_format import neighbour_pairs, preference_format
from horizonkit.llm.queries import SQL


def shown(turns):
    text, spans = "", []
    for role, body in turns:
        text += f"<|{role}|>\n"
        if role == "assistant":
            spans.append((len(text), len(body)))
        text += body + "<|end|>\n"
    return text, spans


def plain(chosen, rejected):
    out = {}
    for p in {r[0] for r in chosen} & {r[0] for r in rejected} - {None}:
        c, r = ([(x[2] or "", x[3] or "") for x in sorted((x for x in s if x[0] == p), key=lambda x: (x[1] is None, x[1] or 0, x[2] or "", x[3] or ""))]
                for s in (chosen, rejected))
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        (a, sa), (b, sb) = shown(c[n:]), shown(r[n:])
        out[p] = (n, shown(c[:n])[0], a, b, sa, sb)
    return out


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "pair_id bigint, turn bigint, role string, text string, prompt string")


def collected(df):
    return {r.pair_id: (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_spans], [tuple(s) for s in r.rejected_spans])
            for r in df.collect()}


def test_equals_plain_loop(frame):
    r = random.Random(6)
    body = ["hi", "ünïcode 漢字", "", None, "two\nlines", "x" * 500]
    sides = [[(p, t, r.choice(["user", "assistant", "system", None]), r.choice(body)) for p in range(60) for t in range(r.randrange(7))] for _ in range(2)]
    sides[1] += [x for x in sides[0] if x[0] % 3 == 0 and x[1] < 4]
    sides[1] = [x for x in sides[1] if x[0] % 3 or x in sides[0]]
    sides[0] += [(None, 0, "user", "no pair"), (100, None, "user", "b"), (100, None, "user", "a"), (100, 3, "assistant", "z" * 100_000)]
    sides[1] += [(None, 0, "user", "no pair"), (100, 3, "assistant", "z" * 100_000), (100, None, "user", "a")]
    assert collected(preference_format(frame(sides[0]), frame(sides[1]))) == plain(*sides)


def test_empty(frame):
    assert preference_format(frame([]), frame([(1, 0, "user", "a")])).collect() == []


def test_neighbour_pairs_equal_sql(spark):
    r = random.Random(7)
    rows = [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "b", "c" * 9])) for c in range(41) for t in range(r.randrange(1, 8))]
    t = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {k: (*v[:4], ",".join(f"{a}+{b}" for a, b in v[4]), ",".join(f"{a}+{b}" for a, b in v[5])) for k, v in collected(preference_format(*neighbour_pairs(t))).items()}
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert got == {x[0]: x[1:] for x in con.execute(SQL["op2_preference_format"]).fetchall()}
