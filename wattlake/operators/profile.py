"""Data profiles: shares, histograms, box-plot numbers, nulls, correlations, matrix inspection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.operators.quantiles import beside, linear, nearest

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def value_shares(df: DataFrame, c: str) -> DataFrame:
    """(value, n, share) of each value, nulls included in the total, commonest first."""
    counts = df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("_t")).alias("share")).orderBy(F.desc("n"), "value")


def histogram(df: DataFrame, c: str, bins: int = 10) -> DataFrame:
    """(bin, low, high, label, n, share): bins of equal width, the last closed; empty bins aren't rows."""
    ends = df.agg(F.min(c).cast("double").alias("_lo"), F.max(c).cast("double").alias("_hi"), F.count("*").alias("_t"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.coalesce(F.least(F.floor(F.try_divide(F.col(c) - F.col("_lo"), width)), F.lit(bins - 1)), F.lit(0))
    counts = df.filter(F.col(c).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(place.cast("int").alias("bin"), "_lo", "_hi", "_t").agg(F.count("*").alias("n"))
    low, high = F.col("_lo") + F.col("bin") * width, F.col("_lo") + (F.col("bin") + 1) * width
    return counts.select("bin", low.alias("low"), high.alias("high"), F.format_string("(%.0f, %.0f)", low, high).alias("label"), "n", (F.col("n") / F.col("_t")).alias("share")).orderBy("bin")


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """One row: the number of different values of each column, null counted as one."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[(count(c) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(c) for c in columns])


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_null, rate) of each column, in one pass."""
    one = df.agg(F.count("*").alias("_t"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return one.unpivot("_t", columns, "column", "n_null").select("column", "n_null", F.coalesce(F.try_divide("n_null", "_t"), F.lit(0.0)).alias("rate"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r): Pearson's r of each pair of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("r")) for i, (a, b) in enumerate(pairs)])).alias("_r")).select("_r.*")


def box_numbers(df: DataFrame, c: str, by: list[str] | None = None, k: float = 1.5) -> DataFrame:
    """One row a group (null is one): quartiles, fences, and how many values are below and above them."""
    q = linear(df, c, QUARTILES, by)
    iqr = F.col("q75") - F.col("q25")
    q = q.withColumn("lower", F.col("q25") - k * iqr).withColumn("upper", F.col("q75") + k * iqr)
    joined = beside(df.filter(F.col(c).isNotNull()), q, by or [])
    keys = [*(by or []), "n", *QUARTILES, "lower", "upper"]
    return joined.groupBy(*keys).agg(F.count_if(F.col(c) < F.col("lower")).alias("n_below"), F.count_if(F.col(c) > F.col("upper")).alias("n_above"))


def target_summary(df: DataFrame, c: str, interpolation: str = "linear") -> DataFrame:
    """One row: min, max, mean, std (sample), q25, median, q75."""
    q = (linear if interpolation == "linear" else nearest)(df, c, QUARTILES).drop("n")
    return df.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).crossJoin(q)


def inspected(df: DataFrame, columns: list[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """(column, min, max, n_nan, n_distinct, n_out, warning) of a feature matrix; NaN stays out of min, max and n_out."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns])).alias("_r")).select("_r.*")
    v = F.nanvl(F.col("v"), F.lit(None).cast("double"))
    out = long.groupBy("column").agg(F.min(v).alias("min"), F.max(v).alias("max"), F.count_if(F.isnan("v")).alias("n_nan"), F.count_distinct(v).alias("n_distinct"), F.count_if((v < low) | (v > high)).alias("n_out"))
    warning = F.when(F.col("n_nan") > 0, "nan").when(F.col("n_distinct") <= 1, "constant").when(F.col("n_out") > 0, "out of bounds").otherwise("")
    return out.withColumn("warning", warning)


def share_rank(df: DataFrame, c: str) -> DataFrame:
    """The commonest value of a column: one row (value, n)."""
    return df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(1)


def before(df: DataFrame, by: list[str], order: list[str], c: str) -> DataFrame:
    """The value of the row before in each group."""
    return df.withColumn(f"{c}_before", F.lag(c).over(Window.partitionBy(*by).orderBy(*order)))
