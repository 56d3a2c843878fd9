"""Fitted encoders: fits are small DataFrames, applying one is a broadcast join or plain expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.scalars import cyclical, min_max, sane
from wattlake.operators.quantiles import linear, nearest
from wattlake.operators.sampling import numbered


def fit_index(df: DataFrame, c: str) -> DataFrame:
    """(value, idx): 0, 1, ... in order of value; the same whatever the order of rows."""
    values = df.select(F.col(c).alias("value")).filter("value is not null").distinct()
    return numbered(values, ["value"], "_n").select("value", F.col("_n").cast("int").alias("idx"))


def apply_index(df: DataFrame, fitted: DataFrame, c: str, out: str | None = None, unseen: int = -1) -> DataFrame:
    """Adds the index of a value; *unseen* for others and null."""
    f = fitted.select(F.col("value").alias(f"_{c}"), F.col("idx").alias("_idx"))
    return df.join(f, df[c] == f[f"_{c}"], "left").withColumn(out or f"{c}_idx", F.coalesce("_idx", F.lit(unseen))).drop(f"_{c}", "_idx")


def index_sizes(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of index values each column needs."""
    return df.agg(*[(F.max(c) + 1).cast("bigint").alias(c) for c in columns])


def within(sizes: dict[str, int]) -> Column:
    """Whether every index of a row is there, not negative and below its size."""
    return reduce(Column.__and__, [F.coalesce(F.col(c).between(0, n - 1), F.lit(False)) for c, n in sizes.items()], F.lit(True))


def out_of_bounds(df: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """One row: rows whose index isn't below its size, and rows that are wholly valid."""
    return df.agg(*[F.count_if(~within({c: n})).alias(f"{c}_out") for c, n in sizes.items()], F.count_if(within(sizes)).alias("n_valid"))


def one_hot(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """A column ``name_value`` of 0 or 1 for each value of a fitted vocabulary; the source goes."""
    new = {f"{c}_{v}": F.when(F.col(c) == v, 1).otherwise(0) for c, values in columns.items() for v in values}
    return df.withColumns(new).drop(*columns)


def vocabulary(df: DataFrame, c: str, most: int = 1000) -> list[str]:
    """Values of a category, sorted; more than *most*, which would each be a column, are an error."""
    values = [r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{c} has more than {most} values")
    return sorted(values)


def fit_clip(df: DataFrame, columns: list[str], low: float = 0.15, high: float = 0.85, k: float = 1.5, interpolation: str = "nearest") -> DataFrame:
    """(column, q1, q3, iqr, lower, upper) of each column that isn't all null."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("v")) for c in columns if c in df.columns])).alias("_r")).select("_r.*")
    q = (nearest if interpolation == "nearest" else linear)(long, "v", {"q1": low, "q3": high}, ["column"]).filter("n > 0")
    iqr = F.col("q3") - F.col("q1")
    return q.select("column", "q1", "q3", iqr.alias("iqr"), (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))


def apply_clip(df: DataFrame, limits: DataFrame) -> DataFrame:
    """Columns with limits are clipped to them and scaled to 0..1.  The limits are one row a column."""
    return df.withColumns({r["column"]: min_max(f"`{r['column']}`", r["lower"], r["upper"]) for r in limits.collect() if r["column"] in df.columns})


def fit_target(df: DataFrame, c: str, target: str, smoothing: float = 10.0) -> DataFrame:
    """(value, encoding, global_mean): the category's mean, drawn to the global one as *smoothing* rows would."""
    total = df.agg(F.avg(target).alias("global_mean"))
    stats = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.avg(target).alias("m"), F.count(target).alias("k"))
    return stats.crossJoin(F.broadcast(total)).select("value", ((F.col("k") * F.col("m") + smoothing * F.col("global_mean")) / (F.col("k") + smoothing)).alias("encoding"), "global_mean")


def apply_target(df: DataFrame, fitted: DataFrame, c: str) -> DataFrame:
    """``c_target_enc`` instead of *c*; the global mean for values that weren't seen and null."""
    mean = F.broadcast(fitted.agg(F.first("global_mean").alias("_g")))
    f = fitted.select(F.col("value").alias("_v"), F.col("encoding").alias("_e"))
    return df.join(f, df[c] == f["_v"], "left").crossJoin(mean).withColumn(f"{c}_target_enc", F.coalesce("_e", "_g")).drop("_v", "_e", "_g", c)


def with_cycle(df: DataFrame, c: str, period: float) -> DataFrame:
    sine, cosine = cyclical(c, period)
    return df.withColumn(f"{c}_sin", sine).withColumn(f"{c}_cos", cosine)


def sanitised(df: DataFrame) -> DataFrame:
    """NaN and infinite values of float columns become 0."""
    return df.withColumns({n: sane(f"`{n}`") for n, t in df.dtypes if t in ("double", "float")})


def dense(df: DataFrame, columns: list[str], out: str = "features") -> DataFrame:
    """The columns as one array of floats."""
    return df.withColumn(out, F.array(*[F.col(f"`{c}`").cast("float") for c in columns]))


def normalisation(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std, min, max) without NaN; 0, 1, 0, 1 for columns without a value.  Population deviation."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias("v")) for c in columns])).alias("_r")).select("_r.*")
    return long.groupBy("column").agg(F.coalesce(F.avg("v"), F.lit(0.0)).alias("mean"), F.coalesce(F.stddev_pop("v"), F.lit(1.0)).alias("std"), F.coalesce(F.min("v"), F.lit(0.0)).alias("min"), F.coalesce(F.max("v"), F.lit(1.0)).alias("max"))
