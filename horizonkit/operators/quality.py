"""Validation and data-quality operators (V1–V6).

Rules are data: ``(rule_id, column, check, lo, hi)``. All rules are
evaluated in one aggregation (``count_if(NOT rule)``), so every failure is
reported together, and violating rows come from one filtered projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    rule_id: str
    column: str
    check: str            # not_null | ge | le | between
    lo: float | None = None
    hi: float | None = None

    def passes(self) -> Column:
        c = F.col(self.column)
        if self.check == "not_null":
            return c.isNotNull()
        if self.check == "ge":
            return c.isNull() | (c >= self.lo)
        if self.check == "le":
            return c.isNull() | (c <= self.hi)
        if self.check == "between":
            return c.isNull() | c.between(self.lo, self.hi)
        raise ValueError(f"unknown check {self.check!r}")


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Coercion before validation: strings like "1.5" become numbers, bad values null."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS {types[c]})").alias(c) if c in types else F.col(c)
                       for c in df.columns])


def validate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """V1 summary: one row per rule with the number of failing rows."""
    aggs = [F.count_if(~r.passes()).alias(f"_r{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.column).alias("column"),
                              F.lit(r.check).alias("check"), F.col(f"_r{i}").alias("n_failed"))
                     for i, r in enumerate(rules)])
    return one.select(F.inline(rows))


def violations(df: DataFrame, rules: Sequence[Rule], id_cols: Sequence[str]) -> DataFrame:
    """V1 detail: one row per (row, failed rule)."""
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.rule_id)) for r in rules]))
    return (df.select(*id_cols, failed.alias("_failed")).where(F.size("_failed") > 0)
              .select(*id_cols, F.explode("_failed").alias("rule_id")))


def assert_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Lazy failing variant: raises at execution when any rule fails."""
    cond = F.lit(True)
    for r in rules:
        cond = cond & r.passes()
    return df.withColumn("_ok", F.when(cond, F.lit(True)).otherwise(
        F.raise_error(F.lit("schema validation failed")))).drop("_ok")


def missing_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V2: percent missing per column, only columns with any missing value."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), (F.col(c) * 100).alias("missing_pct")) for c in cols])
    return one.select(F.inline(rows)).where(F.col("missing_pct") > 0)


def duplicate_ts(df: DataFrame, keys: Sequence[str] = ("series_id",), ts: str = "ts") -> DataFrame:
    """V3: rows minus distinct timestamps, per series."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - F.countDistinct(ts)).alias("duplicate_ts"))


def describe_exact(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """V4: count, mean, sample std, min, exact linear quartiles, max (long format).
    Quartiles use the distributed exact quantile (no group held in one task)."""
    from ..functions.quantiles import exact_quantiles
    keys = list(keys)
    parts = []
    for c in cols:
        x = F.col(c)
        base = df.groupBy(*keys).agg(
            F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"))
        q = exact_quantiles(df, keys, c, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
        parts.append(base.join(q, keys, "left") if keys else
                     base.withColumn("_one", F.lit(1)).join(q.withColumn("_one", F.lit(1)), "_one", "left").drop("_one"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V5: rows with any missing measure."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.where(cond)


def drop_null_report(df: DataFrame, keys: Sequence[str] = ("series_id",), cols: Sequence[str] | None = None) -> DataFrame:
    """V6: rows before/after a drop-any-null and the share lost, per series."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in keys]
    complete = None
    for c in cols:
        complete = F.col(c).isNotNull() if complete is None else (complete & F.col(c).isNotNull())
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(complete).alias("rows_after"))
    return g.withColumn("rows_lost", F.col("rows_before") - F.col("rows_after")).withColumn(
        "lost_pct", F.col("rows_lost") * 100.0 / F.col("rows_before"))
