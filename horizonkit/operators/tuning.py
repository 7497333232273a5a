"""Parameter search on a hold-out (P5): proposals from the densities of good and bad
trials, successive halving of the number of rounds, and a stored trial table.

Trials come in generations. What a generation proposes depends on the seed and on the
stored losses of the generations before it, never on timing, so its trials can run side
by side and a search that was stopped goes on from its table to the same end. All trials
of a generation run with the fewest rounds, the best of them with more, and so on."""

from __future__ import annotations

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import list_names

SCHEMA = "trial int, generation int, rung int, rounds int, params string, loss double"
_CANDIDATES = 24


class Choice(tuple):
    """One of some values."""

    def draw(self, r: random.Random):
        return r.choice(self)

    def near(self, r: random.Random, seen: Sequence):
        return r.choice([*seen, r.choice(self)])

    def density(self, x, seen: Sequence) -> float:
        return (sum(x == v for v in seen) + 1 / len(self)) / (len(seen) + 1)


class Between:
    """A number between two bounds, on a log scale if ``log``."""

    def __init__(self, low: float, high: float, log: bool = False, digits: int = 4):
        self.low, self.high, self.log, self.digits = low, high, log, digits

    def _to(self, x: float) -> float:
        return (math.log(x / self.low) / math.log(self.high / self.low)) if self.log else (x - self.low) / (self.high - self.low)

    def _from(self, u: float) -> float:
        u = min(1.0, max(0.0, u))
        return round(self.low * (self.high / self.low) ** u if self.log else self.low + u * (self.high - self.low), self.digits)

    def draw(self, r: random.Random) -> float:
        return self._from(r.random())

    def near(self, r: random.Random, seen: Sequence) -> float:
        return self._from(r.gauss(self._to(r.choice(seen)), self._width(seen)))

    def _width(self, seen: Sequence) -> float:
        return max(0.05, 0.5 / (1 + len(seen)))

    def density(self, x: float, seen: Sequence) -> float:
        s, u = self._width(seen), self._to(x)
        return (1 + sum(math.exp(-((u - self._to(v)) / s) ** 2 / 2) / (s * math.sqrt(2 * math.pi)) for v in seen)) / (len(seen) + 1)


def propose(space: dict, done: Sequence[tuple[dict, float]], trial: int, seed: int, start: int = 8, share: float = 0.25) -> dict:
    """Parameters of a trial: drawn at random for the first ``start``; then, of candidates
    drawn around good trials, the one likeliest good rather than bad."""
    r = random.Random(f"{seed}/{trial}")
    if len(done) < start:
        return {k: s.draw(r) for k, s in space.items()}
    ranked = [p for p, _ in sorted(done, key=lambda x: (x[1], json.dumps(x[0], sort_keys=True)))]
    cut = max(1, math.ceil(share * len(ranked)))
    good, bad = ranked[:cut], ranked[cut:]
    best = None
    for _ in range(_CANDIDATES):
        x = {k: s.near(r, [p[k] for p in good]) for k, s in space.items()}
        gain = sum(math.log(s.density(x[k], [p[k] for p in good])) - math.log(s.density(x[k], [p[k] for p in bad])) for k, s in space.items())
        if best is None or gain > best[0]:
            best = (gain, x)
    return best[1]


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    if not any(n.startswith("trial=") for n in list_names(spark, path)):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{path}/trial=*/rung=*")


def search(spark: SparkSession, evaluate: Callable[[dict, int], float | None], space: dict, path: str, trials: int = 20, generation: int = 5,
           rungs: Sequence[int] = (5, 20), keep: int = 2, seed: int = 42, parallelism: int = 4) -> DataFrame:
    """The trial table, best first within the highest rung. ``evaluate(params, rounds)``
    gives the loss on the hold-out (none or NaN counts as the worst). Every evaluation is
    written under ``path`` as it ends; one that is there is not made again."""
    known = {(r.trial, r.rung): r.loss for r in read_trials(spark, path).collect()}  # a row per evaluation

    def run(job: tuple) -> tuple:
        t, g, rung, params = job
        if (t, rung) in known:
            return t, known[t, rung]
        loss = evaluate(dict(params), rungs[rung])
        loss = math.inf if loss is None or math.isnan(loss) else float(loss)
        row = spark.createDataFrame([(t, g, rung, rungs[rung], json.dumps(params, sort_keys=True), loss)], SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/trial={t}/rung={rung}")
        return t, loss

    done: list[tuple[dict, float]] = []
    with ThreadPoolExecutor(parallelism) as pool:
        for g in range(math.ceil(trials / generation)):
            numbers = range(g * generation, min(trials, (g + 1) * generation))
            params = {t: propose(space, done, t, seed) for t in numbers}
            alive, first = list(numbers), {}
            for rung in range(len(rungs)):
                losses = dict(pool.map(run, [(t, g, rung, params[t]) for t in alive]))
                first = first or losses
                alive = sorted(alive, key=lambda t: (losses[t], t))[:max(1, keep if rung == 0 else keep // 2)]
            done += [(params[t], first[t]) for t in numbers]
    return read_trials(spark, path).orderBy(F.desc("rung"), "loss", "trial")
