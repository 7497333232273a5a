"""Query registry: ``(spark, sf_dir) -> DataFrame`` callables keyed by
inventory ID, and the matching oracle SQL where one exists."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import ROUND_LIMIT, ROUND_OFFSET, round_doubles
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def portable_rounding(sql: str, digits: int = O.R) -> str:
    """Rewrite every ``round(expr, digits)`` to ``(floor((expr) * 1e<d> + c) / 1e<d>)``
    with the constant ``c`` of ``functions.exprs.ROUND_OFFSET``.

    Engines round decimal ties differently (decimal-string HALF_UP vs scaled
    binary) and may return -0.0; the floor form is the same IEEE arithmetic in
    both, so identical inputs give bit-identical outputs (``round_doubles``
    applies the same formula on the Spark side). The offset moves the rounding
    boundary away from exact decimal ties, where a one-ulp difference from a
    different summation order would otherwise flip the last digit."""
    needle = "round("
    out, i = [], 0
    while True:
        j = sql.find(needle, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + len(needle)])
            i = j + len(needle)
            continue
        depth, k, comma = 1, j + len(needle), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        arg, nd = sql[j + len(needle):comma], sql[comma + 1:k - 1].strip()
        if nd != str(digits):
            out.append(sql[i:k])
        else:
            e = portable_rounding(arg, digits)
            out.append(sql[i:j] + f"(CASE WHEN abs({e}) < {ROUND_LIMIT!r} THEN floor(({e}) * 1e{digits} + "
                                  f"{ROUND_OFFSET!r}) / 1e{digits} ELSE ({e}) END)")
        i = k


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = portable_rounding(sql)
        return fn
    return deco


def out(df: DataFrame) -> DataFrame:
    return round_doubles(df, O.R)
