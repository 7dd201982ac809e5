"""Time series of counts per region: least squares on trend, harmonics and lags.

The terms of a row are one array. Their products, summed per region in one aggregate, are the normal
equations; a region's system is as small as the number of terms and is solved in expressions within
its row. So the rows are read once, shrink on the map side, and no row leaves the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from miasma.functions.calendar import week_start_date
from miasma.operators.features import REGION

YEAR_DAYS = 365.25
LAGS = ("lag_cases", "lag_cases_2", "lag_cases_3")
# A term whose remaining square sum is below this share of its own is a sum of the terms before it.
DEPENDENT = 1e-10


def terms(harmonics: int = 2, lags: Sequence[str] = (), trend: bool = True) -> dict[str, Column]:
    """Named terms of a week's count: constant, years since 2000, waves of the year, earlier counts."""
    day = F.unix_date(week_start_date(F.col("year"), F.col("weekofyear")))
    years = (day - F.lit(10957)).cast("double") / F.lit(YEAR_DAYS)
    out = {"constant": F.lit(1.0)}
    if trend:
        out["trend"] = years
    for k in range(1, harmonics + 1):
        angle = F.lit(2 * math.pi * k) * years
        out |= {f"sin_{k}": F.sin(angle), f"cos_{k}": F.cos(angle)}
    return out | {c: F.col(c).cast("double") for c in lags}


def normal_equations(rows: DataFrame, terms: dict[str, Column], target: Column | str = "total_cases",
                     keys=(REGION,)) -> DataFrame:
    """Per region the number of rows ``n``, the sums of products ``xx`` (a full square as an array of
    arrays), ``xy`` and ``yy``. Rows with a null term or count take no part.

    Each product of two terms is summed once; partial sums are what is shuffled.
    """
    y = (F.col(target) if isinstance(target, str) else target).cast("double")
    p, names = len(terms), [f"x{i}" for i in range(len(terms))]
    wide = rows.select(*keys, *[c.alias(n) for c, n in zip(terms.values(), names)], y.alias("y")).dropna(subset=[*names, "y"])
    sums = {(i, j): F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)}
    found = wide.groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy"), *sums.values(),
        *[F.sum(F.col(n) * F.col("y")).alias(f"t{i}") for i, n in enumerate(names)])
    square = F.array(*[F.array(*[F.col(f"s{min(i, j)}_{max(i, j)}") for j in range(p)]) for i in range(p)])
    return found.select(*keys, "n", square.alias("xx"), F.array(*[F.col(f"t{i}") for i in range(p)]).alias("xy"), "yy")


def _solved(xx: Column, xy: Column, p: int) -> Column:
    """Coefficients of a symmetric system by elimination, one pivot after the other.

    Terms are first brought to length one, so the pivots tell how much of a term the terms before it
    leave over; one that is a sum of them gets coefficient 0.
    """
    scale = F.transform(xx, lambda row, i: F.sqrt(F.get(row, i)))
    unit = F.transform(xx, lambda row, i: F.concat(
        F.zip_with(row, scale, lambda v, s: F.coalesce(F.try_divide(v, s * F.get(scale, i)), F.lit(0.0))),
        F.array(F.coalesce(F.try_divide(F.get(xy, i), F.get(scale, i)), F.lit(0.0)))))

    def eliminate(m: Column, k: Column) -> Column:
        own = F.get(m, k)
        pivot = F.get(own, k)
        dependent = pivot < DEPENDENT
        # Row k divided by its pivot; nothing is taken away where the term is left out.
        line = F.transform(own, lambda v: F.when(dependent, F.lit(0.0)).otherwise(v / pivot))
        return F.transform(m, lambda row, i: F.when(i == k, line).otherwise(
            F.zip_with(row, line, lambda a, b: a - F.get(row, k) * b)))

    found = F.aggregate(F.array(*[F.lit(i) for i in range(p)]), unit, eliminate)
    return F.zip_with(F.transform(found, lambda row: F.get(row, p)), scale, lambda v, s: F.coalesce(F.try_divide(v, s), F.lit(0.0)))


def fit_series(rows: DataFrame, terms: dict[str, Column], target: Column | str = "total_cases", keys=(REGION,)) -> DataFrame:
    """Per region: keys, ``n``, ``names`` and ``coefficients`` of the terms, ``sse`` (sum of squared
    residuals) and the normal equations they come from.

    A region with fewer rows than terms, or with terms that are sums of others, has the coefficient 0
    for what its rows cannot tell apart.
    """
    sums = normal_equations(rows, terms, target, keys)
    fitted = sums.withColumn("coefficients", _solved(F.col("xx"), F.col("xy"), len(terms)))
    explained = F.aggregate(F.zip_with("coefficients", "xy", lambda c, v: c * v), F.lit(0.0), lambda a, v: a + v)
    return fitted.select(*keys, "n", F.array(*[F.lit(n) for n in terms]).alias("names"), "coefficients",
                         F.greatest(F.col("yy") - explained, F.lit(0.0)).alias("sse"), "xx", "xy")


def predict_series(model: DataFrame, rows: DataFrame, terms: dict[str, Column], keys=(REGION,)) -> DataFrame:
    """``rows`` of the regions that the model knows, with ``prediction``; null where a term is null."""
    joined = rows.join(model.select(*keys, "coefficients"), list(keys))
    value = F.lit(0.0)
    for i, term in enumerate(terms.values()):
        value = value + F.get("coefficients", i) * term
    return joined.withColumn("prediction", value).drop("coefficients")


def weeks_after(cases: DataFrame, horizon: int, keys=(REGION,)) -> DataFrame:
    """(keys, year, weekofyear) of the ``horizon`` weeks after the last count of each region.

    Weeks are numbered from January 1 in sevens, as ``week_start_date`` counts them; a year has 52.
    """
    last = cases.groupBy(*keys).agg(F.max(F.struct("year", "weekofyear")).alias("last"))
    at = F.col("last.year") * 52 + F.least(F.col("last.weekofyear"), F.lit(52)) - 1
    ahead = last.select(*keys, F.explode(F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: at + h)).alias("at"))
    return ahead.select(*keys, F.floor(F.col("at") / 52).cast("int").alias("year"), (F.col("at") % 52 + 1).cast("int").alias("weekofyear"))
