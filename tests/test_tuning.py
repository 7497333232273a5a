"""Adaptive search: restart, halving, and better proposals than chance."""
import json
import math
import random

import pytest

from horizonkit.operators.tuning import Between, Choice, propose, read_trials, search

SPACE = {"x": Between(0.0, 1.0), "y": Between(0.001, 1.0, log=True), "kind": Choice(("a", "b", "c"))}


def loss(p, rounds):
    return (p["x"] - 0.3) ** 2 + 0.1 * math.log10(p["y"] / 0.02) ** 2 + (0 if p["kind"] == "b" else 0.3) + 1 / rounds


def test_resumed_search_ends_in_the_same_table(spark, tmp_path):
    calls = []

    def counted(p, rounds):
        calls.append((json.dumps(p, sort_keys=True), rounds))
        return loss(p, rounds)

    whole = [tuple(r) for r in search(spark, counted, SPACE, str(tmp_path / "a"), trials=12, generation=4, rungs=(5, 20), keep=2, parallelism=2).collect()]
    assert len(whole) == 12 + 3 * 2 == len(calls) and whole[0][2] == 1 and whole[0][5] == min(r[5] for r in whole)
    made = []

    def stops(p, rounds):
        if len(made) >= 7:
            raise RuntimeError("lost")
        made.append((json.dumps(p, sort_keys=True), rounds))
        return loss(p, rounds)

    with pytest.raises(RuntimeError):
        search(spark, stops, SPACE, str(tmp_path / "b"), trials=12, generation=4, rungs=(5, 20), keep=2, parallelism=1)
    kept = read_trials(spark, str(tmp_path / "b")).count()
    assert kept == 7
    calls.clear()
    again = [tuple(r) for r in search(spark, counted, SPACE, str(tmp_path / "b"), trials=12, generation=4, rungs=(5, 20), keep=2, parallelism=2).collect()]
    assert again == whole and len(calls) == 18 - 7 and not set(calls) & set(made)
    for g in range(3):  # the two best of the first rung go on
        first = sorted((r[5], r[0]) for r in whole if r[1] == g and r[2] == 0)
        assert sorted(r[0] for r in whole if r[1] == g and r[2] == 1) == sorted(t for _, t in first[:2])


def test_failed_evaluations_are_the_worst(spark, tmp_path):
    out = search(spark, lambda p, n: None if p["x"] > 0.5 else float("nan"), SPACE, str(tmp_path), trials=3, generation=3, rungs=(1,)).collect()
    assert [r.loss for r in out] == [math.inf] * 3


def test_proposals_beat_chance():
    wins = 0
    for seed in range(20):
        done = []
        for t in range(30):
            p = propose(SPACE, done, t, seed)
            assert 0 <= p["x"] <= 1 and 0.001 <= p["y"] <= 1 and p["kind"] in "abc"
            done.append((p, loss(p, 10)))
        r = random.Random(seed)
        chance = min(loss({k: s.draw(r) for k, s in SPACE.items()}, 10) for _ in range(30))
        wins += min(v for _, v in done) < chance
    assert wins >= 14
