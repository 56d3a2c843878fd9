"""Splits, samples, folds and top rows that don't depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import stash

BUCKETS = 10_000


def bucket(key: str, seed: int = 42) -> Column:
    """0..BUCKETS - 1 by integer arithmetic on a whole-number key, of any size, the same in any engine; null for null."""
    return F.pmod(F.pmod(F.col(key), F.lit(BUCKETS)) * (7919 * 31) + seed * 104_729 * 31 % BUCKETS + F.col(key) % 101, F.lit(BUCKETS))


def with_split(df: DataFrame, key: str, test: float = 0.15, validation: float = 0.0, seed: int = 42) -> DataFrame:
    """Adds ``split``: test, validation or train, decided by the key alone; a row without a key is for training."""
    b = bucket(key, seed)
    return df.withColumn("split", F.when(b < int(test * BUCKETS), "test").when(b < int((test + validation) * BUCKETS), "validation").otherwise("train"))


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """*n* rows, by a hash of the key (those without one last): a top-n, so no task but the last merges more than n rows."""
    return df.orderBy(bucket(key, seed).asc_nulls_last(), key).limit(n)


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, order: list, out: str) -> DataFrame:
    """Adds *out*: 0, 1, ... in *order*.

    The sort is by ranges and kept once, so every later look sees the same order; only a row for
    each of its partitions meets in one task.
    """
    ordered = stash(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    place, part = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)), F.shiftright("_m", 33)
    sizes = ordered.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = sizes.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return ordered.withColumn("_p", part).join(F.broadcast(before), "_p").withColumn(out, place + F.col("_o")).drop("_m", "_p", "_o")


def folds(df: DataFrame, key: str, k: int) -> DataFrame:
    """Adds ``fold`` 0..k-1: contiguous stretches of the key's order with nearly as many rows each."""
    rows = numbered(df, [key], "_i")
    total = rows.agg(F.count("*").alias("_t"))
    # the first n mod k folds have a row more
    small, extra = F.floor(F.col("_t") / k), F.col("_t") % k
    cut = extra * (small + 1)
    fold = F.when(F.col("_i") < cut, F.floor(F.col("_i") / (small + 1))).otherwise(extra + F.floor(F.try_divide(F.col("_i") - cut, small)))
    return rows.crossJoin(F.broadcast(total)).withColumn("fold", fold.cast("int")).drop("_t", "_i")
