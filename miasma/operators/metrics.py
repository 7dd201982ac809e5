"""Forecast quality as one aggregate, overall or per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from miasma.functions.numeric import ape


def regression_metrics(scored: DataFrame, actual: str = "total_cases",
                       predicted: str = "prediction", keys=(), overall: bool = False) -> DataFrame:
    """n, R², RMSE, MAE, MAPE and accuracy (100 - MAPE) in one pass.

    R² needs the spread of the actual values; it comes from ``var_pop``, which Spark merges
    stably across partitions. Rows with no cases have no percentage error and are left out
    of MAPE. ``overall`` adds the total over ``keys``, with null keys, in the same pass.
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    groups = scored.rollup(*keys) if overall else scored.groupBy(*keys)
    grouped = groups.agg(
        F.count("*").alias("n"),
        F.avg((a - p) * (a - p)).alias("mse"),
        F.avg(F.abs(a - p)).alias("mae"),
        F.var_pop(a).alias("spread"),
        F.avg(ape(a, p)).alias("mean_ape"))
    mape = F.col("mean_ape") * 100
    return grouped.select(
        *keys, "n",
        (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
        F.sqrt("mse").alias("rmse"), "mae",
        mape.alias("mape"), (100 - mape).alias("accuracy"))
