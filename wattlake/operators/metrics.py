"""Error metrics, their roll-up, and comparisons of models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.scalars import relative_error

# The metrics' names.
NAMES = ["MAE", "RMSE", "R2", "MAPE", "WMAPE", "Acuracia"]


def error_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None, accuracy_of: str = "MAPE") -> DataFrame:
    """One row a group: n and the metrics, all from sums of one pass.

    MAPE takes actual values as 1e-8 at least; WMAPE is null where they are all zero, R2 where
    they are all alike.  Acuracia is 100 less MAPE or WMAPE, whichever is named.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    rows = df.filter(y.isNotNull() & p.isNotNull()).select(*(by or []), y.alias("_y"), (p - y).alias("_e"), relative_error(y, p).alias("_r"))
    sums = rows.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        F.avg(F.abs("_e")).alias("MAE"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("RMSE"),
        F.sum(F.col("_e") * F.col("_e")).alias("_se"),
        (F.var_pop("_y") * F.count("*")).alias("_st"),
        F.avg("_r").alias("MAPE"),
        F.sum(F.abs("_e")).alias("_ae"),
        F.sum(F.abs("_y")).alias("_ay"),
    )
    out = sums.withColumn("R2", 1 - F.try_divide("_se", "_st")).withColumn("WMAPE", 100 * F.try_divide("_ae", "_ay"))
    return out.select(*(by or []), "n", "MAE", "RMSE", "R2", "MAPE", "WMAPE", (100 - F.col(accuracy_of)).alias("Acuracia"))


def weighted(per_segment: DataFrame, columns: list[str], weight: str = "n_test") -> DataFrame:
    """One row: each metric's mean over segments, weighed by rows; segments without the metric don't count."""
    w = F.col(weight)
    return per_segment.agg(F.sum(w).alias(weight), *[F.try_divide(F.sum(F.col(c) * w), F.sum(F.when(F.col(c).isNotNull(), w))).alias(c) for c in columns])


def tally(df: DataFrame, actual: str, champion: str, challenger: str, by: list[str] | None = None) -> DataFrame:
    """One row a group and winner: rows, and the mean relative gain of the challenger in percent points."""
    a, b = relative_error(F.col(actual), F.col(champion)), relative_error(F.col(actual), F.col(challenger))
    winner = F.when(b < a, "challenger").when(a < b, "champion").otherwise("tie")
    return df.select(*(by or []), winner.alias("winner"), (a - b).alias("_g")).groupBy(*(by or []), "winner").agg(F.count("*").alias("n"), F.avg("_g").alias("mean_gain"))


def ranked(models: DataFrame, metric: str = "MAPE", by: list[str] | None = None) -> DataFrame:
    """*models* with ``rank``: 1 for the least error (ties in order of name); one row a model, so groups are small."""
    order = Window.partitionBy(*(by or [F.lit(1)])).orderBy(F.col(metric).asc_nulls_last(), "model")
    return models.withColumn("rank", F.row_number().over(order))
