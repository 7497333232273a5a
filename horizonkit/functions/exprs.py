"""Column-expression helpers: null handling and forecast-error aggregates.

Everything here is a JVM-side expression, so it stays inside whole-stage
codegen and works as a partial (map-side) aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timecols import col


def nan_to_null(c) -> Column:
    """NaN never enters the engine: it sorts above everything and poisons sums."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in cols], F.lit(False))


def all_not_null(cols) -> Column:
    return reduce(lambda a, b: a & b, [col(c).isNotNull() for c in cols], F.lit(True))


def safe_div(a, b) -> Column:
    """a / b with a zero denominator → NULL (ANSI mode would raise)."""
    return col(a) / F.nullif(col(b), F.lit(0.0))


# ---- forecast-error aggregates (M1–M5); rows with a missing side are skipped
def _err(actual, forecast):
    a, f = col(actual), col(forecast)
    ok = a.isNotNull() & f.isNotNull()
    return a, f, ok


def mae(actual="actual", forecast="forecast") -> Column:
    a, f, ok = _err(actual, forecast)
    return F.avg(F.when(ok, F.abs(a - f)))


def rmse(actual="actual", forecast="forecast") -> Column:
    a, f, ok = _err(actual, forecast)
    return F.sqrt(F.avg(F.when(ok, (a - f) * (a - f))))


def mape(actual="actual", forecast="forecast") -> Column:
    """Percent; rows with a zero actual are excluded."""
    a, f, ok = _err(actual, forecast)
    return F.avg(F.when(ok, F.abs((a - f) / F.nullif(a, F.lit(0.0))))) * 100


def smape(actual="actual", forecast="forecast") -> Column:
    """Percent; rows where both sides are zero are excluded."""
    a, f, ok = _err(actual, forecast)
    return F.avg(F.when(ok, 2 * F.abs(a - f) / F.nullif(F.abs(a) + F.abs(f), F.lit(0.0)))) * 100


def n_scored(actual="actual", forecast="forecast") -> Column:
    _, _, ok = _err(actual, forecast)
    return F.count_if(ok)


def metric_aggs(actual="actual", forecast="forecast") -> list[Column]:
    return [mae(actual, forecast).alias("MAE"), rmse(actual, forecast).alias("RMSE"),
            mape(actual, forecast).alias("MAPE"), smape(actual, forecast).alias("sMAPE"),
            n_scored(actual, forecast).alias("n")]


def point_loss(kind: str, actual="actual", forecast="forecast") -> Column:
    """Pointwise loss: 'absolute' or 'squared'. Unknown kinds fail before planning."""
    a, f = col(actual), col(forecast)
    if kind == "absolute":
        return F.abs(a - f)
    if kind == "squared":
        return (a - f) * (a - f)
    raise ValueError(f"a loss is 'absolute' or 'squared', not {kind!r}")


# Fixed value: rounding offset of the comparison edge (boundary at the fractional
# part 0.381966…, away from the exact decimal ties that decimal data produces).
ROUND_OFFSET = 0.6180339887498949
ROUND_LIMIT = 1e12  # larger magnitudes are left unrounded (no long overflow)


def portable_round(c, digits: int = 6) -> Column:
    """``floor(x·10^d + c) / 10^d``: plain IEEE arithmetic, so any engine
    evaluating the same formula on the same double gets the same bits (no
    decimal-tie or negative-zero differences); error < 10^-d. Magnitudes of
    ``ROUND_LIMIT`` and above pass through unchanged."""
    scale = float(10 ** digits)
    x = col(c)
    return F.when(F.abs(x) < F.lit(ROUND_LIMIT), F.floor(x * F.lit(scale) + F.lit(ROUND_OFFSET)) / F.lit(scale)) \
        .otherwise(x)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (used at the edge of comparison queries)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(portable_round(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
