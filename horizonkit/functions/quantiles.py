"""Exact linear-interpolated quantiles without holding a group in one task.

``percentile`` (and ``median``) keep every distinct value of a group in one
aggregation buffer; a series holding a third of all rows would not fit. Here:

1. one partial aggregation counts each distinct value of each group, so tied
   values cost one row from there on;
2. approximate splitters (of the distinct values) part a group's values into
   ``PARTS`` ranges, whose exact counts give each range its first rank;
3. only the range that holds a wanted rank is put in order, and the values at
   ranks ``floor(q(n-1))`` and ``ceil(q(n-1))`` are interpolated — the same
   definition as ``percentile``.

The splitters only balance the work: counts are exact, so the result is exact
for any of them, and there is no second way to fall back on.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges a group's distinct values are parted into.
PARTS = 256


def _name(q: float) -> str:
    return f"q{round(q * 1000):04d}"


def exact_quantiles(df: DataFrame, keys: Sequence[str], col: str, qs: Sequence[float], accuracy: int = 10_000,
                    names: Sequence[str] | None = None) -> DataFrame:
    """``keys..., <name per q>`` with exact linear quantiles of non-null ``col``.
    ``accuracy`` is that of the splitters."""
    keys = list(keys)
    if not keys:  # one global group: a constant key keeps every step a keyed join
        return exact_quantiles(df.withColumn("_all", F.lit(1)), ["_all"], col, qs, accuracy, names).drop("_all")
    names = list(names) if names else [_name(q) for q in qs]
    counted = (df.select(*keys, F.col(col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
               .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    splits = counted.groupBy(*keys).agg(
        F.percentile_approx("_v", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)]), accuracy).alias("_s"))
    part = F.size(F.filter("_s", lambda s: s < F.col("_v")))
    placed = counted.join(splits, keys).select(*keys, "_v", "_c", part.alias("_p"))
    # one row per range: rows before it in the group (at most PARTS rows a group)
    totals = placed.groupBy(*keys, "_p").agg(F.sum("_c").alias("_t"))
    up_to = Window.partitionBy(*keys).orderBy("_p")
    totals = totals.select(*keys, "_p", "_t", F.sum("_t").over(up_to).alias("_end"), F.sum("_t").over(Window.partitionBy(*keys)).alias("_n"))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), r.alias("r")) for i, q in enumerate(qs)
                      for k in [F.lit(float(q)) * (F.col("_n") - 1)] for r in (F.floor(k), F.ceil(k))])
    wanted = totals.select(*keys, "_p", "_n", (F.col("_end") - F.col("_t")).alias("_before"), "_end", ranks.alias("_r"))
    wanted = wanted.withColumn("_r", F.array_distinct(F.filter("_r", lambda x: (x["r"] >= F.col("_before")) & (x["r"] < F.col("_end")))))
    wanted = wanted.where(F.size("_r") > 0).drop("_end")
    inside = placed.join(wanted, [*keys, "_p"])
    inside = inside.withColumn("_last", F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_p").orderBy("_v")) - 1)
    hits = F.filter("_r", lambda x: (x["r"] <= F.col("_last")) & (x["r"] > F.col("_last") - F.col("_c")))
    found = inside.select(*keys, "_n", "_v", F.inline(hits))
    out = []
    for i, (q, name) in enumerate(zip(qs, names)):
        k = F.lit(float(q)) * (F.col("_n") - 1)
        low, high = (F.max(F.when((F.col("i") == i) & (F.col("r") == r), F.col("_v"))) for r in (F.floor(k), F.ceil(k)))
        out.append((low + (k - F.floor(k)) * (high - low)).alias(name))
    return found.groupBy(*keys, "_n").agg(*out).drop("_n")
