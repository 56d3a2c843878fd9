"""Profiles that merge: what a table's columns hold, in sketches of fixed size, extended by new rows without reading old ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: log2 of the distinct sketch's buckets (standard error 1.04 / sqrt(2 ** HLL), 0.8 %; exact for some hundred values), frequent items
#: that are tracked (counts are off by 3.5 / ITEMS of the rows at most, not at all if there are no more values), k of the quantile sketch (rank error about 1.6 %).
HLL, ITEMS, KLL = 14, 4096, 200


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A row a column: n, n_null, least and greatest as text and as numbers, and sketches of distinct values, frequent values and quantiles.

    One look at the rows; tasks hand on a sketch a column.  Values of all types are taken as text,
    numbers besides as doubles; NaN is a value, but in no quantile.
    """
    columns = columns or df.columns
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    entries = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"), (F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) if c in numbers else F.lit(None).cast("double")).alias("number")) for c in columns]
    long = df.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    there = "FILTER (WHERE value IS NOT NULL)"
    return long.groupBy("column").agg(
        F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("n_null"), F.min("value").alias("least"), F.max("value").alias("greatest"), F.min("number").alias("low"), F.max("number").alias("high"),
        F.expr(f"hll_sketch_agg(value, {HLL}) {there}").alias("values"), F.expr(f"approx_top_k_accumulate(value, {ITEMS}) {there}").alias("items"),
        F.expr(f"kll_sketch_agg_double(number, {KLL}) FILTER (WHERE number IS NOT NULL)").alias("ranks"),
    )


def merged(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows of several profiles, from their sketches alone."""
    whole = reduce(DataFrame.unionByName, profiles)
    return whole.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("values").alias("values"), F.expr(f"approx_top_k_combine(items, {ITEMS})").alias("items"), F.expr("kll_merge_agg_double(ranks) FILTER (WHERE ranks IS NOT NULL)").alias("ranks"),
    )


def summary(found: DataFrame) -> DataFrame:
    """(column, n, n_null, null_rate, least, greatest, low, high, n_distinct) of a profile; n_distinct within the sketch's error."""
    rate = F.coalesce(F.try_divide("n_null", "n"), F.lit(0.0))
    return found.select("column", "n", "n_null", rate.alias("null_rate"), "least", "greatest", "low", "high", F.coalesce(F.hll_sketch_estimate("values"), F.lit(0)).alias("n_distinct"))


def frequent(found: DataFrame, k: int = 10) -> DataFrame:
    """(column, value, n, share): the *k* most frequent values of each column, counts within the sketch's error."""
    rows = found.filter("n > n_null").select("column", "n", F.explode(F.expr(f"approx_top_k_estimate(items, {k})")).alias("_t"))
    return rows.select("column", F.col("_t.item").alias("value"), F.col("_t.count").alias("n"), (F.col("_t.count") / F.col("n")).alias("share"))


def quantiles(found: DataFrame, shares: list[float]) -> DataFrame:
    """(column, share, value) of the numeric columns, within the sketch's rank error."""
    each = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.expr(f"kll_sketch_get_quantile_double(ranks, {float(q)}D)").alias("value")) for q in shares])
    return found.filter("low is not null").select("column", F.explode(each).alias("_q")).select("column", "_q.*")
