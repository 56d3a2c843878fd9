"""Quantiles per group that no task needs all of a group's rows for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import stash

#: Steps of the grid of approximate quantiles, their accuracy, and the group size from which it is used.
GRID, ACCURACY, SMALL = 512, 10_000, 4096
#: Different values of a bracket that one task ranks, and the steps in which a larger one is narrowed.
MOST, STEPS = 100_000, 64


def beside(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """*left* with the columns of *right*, which has one row a group; null is a group."""
    if not by:
        return left.crossJoin(F.broadcast(right))
    renamed = right.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = reduce(Column.__and__, [left[c].eqNullSafe(renamed[f"_by_{c}"]) for c in by])
    return left.join(renamed, same).drop(*[f"_by_{c}" for c in by])


def grid(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """One row a group: n and a grid of approximate quantiles, for any number of calls of :func:`nearest`; kept once."""
    base = df.filter(F.col(value).isNotNull())
    return stash(base.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.percentile_approx(value, [i / GRID for i in range(GRID + 1)], ACCURACY).alias("_g")))


def _ranked(df: DataFrame, value: str, wanted: dict[str, tuple[Column, dict[str, Column]]], by: list[str], known: DataFrame) -> DataFrame:
    """One row a group: n and, for each wanted share, the values of the ranks (from 0) asked for about it, by the grid *known*.

    Exact: the grid, whose rank error is bounded, brackets the ranks about a share; what lies
    below a bracket is counted, and values inside it, a few thousandths of the rows, are counted
    one by one.  Brackets with more than MOST different values are narrowed until they have no
    more, so no task ranks a share of a group.  Small groups are ranked whole.
    """
    base = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    wide = F.col("n") >= SMALL
    low, high = [], []
    for i, (q, _) in enumerate(wanted.values()):
        low.append(F.when(wide & (q * GRID >= 1), F.get("_g", (F.floor(q * GRID) - 1).cast("int"))).alias(f"_lo{i}"))
        high.append(F.when(wide & (q * GRID <= GRID - 1), F.get("_g", (F.ceil(q * GRID) + 1).cast("int"))).alias(f"_hi{i}"))
    ranks = {name: (i, k) for i, (_, asked) in enumerate(wanted.values()) for name, k in asked.items()}
    brackets = stash(known.select(*by, "n", *[k.alias(f"_k_{name}") for name, (_, k) in ranks.items()], *low, *high))  # a row a group; two passes read it
    joined = beside(base, brackets.select(*by, *[c for c in brackets.columns if c[:3] in ("_lo", "_hi")]), by)
    below = joined.groupBy(*by).agg(F.array(*[F.count_if(F.col("_v") < F.col(f"_lo{i}")) for i in range(len(wanted))]).alias("_b"))
    inside = [F.when(F.coalesce(F.col("_v") >= F.col(f"_lo{i}"), F.lit(True)) & F.coalesce(F.col("_v") <= F.col(f"_hi{i}"), F.lit(True)), F.lit(i)) for i in range(len(wanted))]
    counts = joined.select(*by, "_v", F.explode(F.array_compact(F.array(*inside))).alias("_i")).groupBy(*by, "_i", "_v").agg(F.count("*").alias("_c"))
    needs = beside(brackets.select(*by, "n", *[f"_k_{name}" for name in ranks]), below, by)
    asked = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(name).alias("_name"), (F.col(f"_k_{name}") - F.get("_b", F.lit(i))).cast("long").alias("_k")) for name, (i, _) in ranks.items()])
    needs = needs.select(*by, "n", F.explode(asked).alias("_a")).select(*by, "n", "_a.*")
    found = _at_ranks(counts, needs, by)
    return found.groupBy(*by).agg(F.max("n").alias("n"), *[F.min(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks])


def _at_ranks(counts: DataFrame, needs: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, _name, _v): the value at rank _k of each of *needs* (by, n, _i, _name, _k) among *counts* (by, _i, _v, _c)."""
    counts, needs = stash(counts), stash(needs)
    while True:
        most = counts.groupBy(*by, "_i").count().agg(F.max("count")).first()[0] or 0
        if most <= MOST:
            break
        counts, needs = _narrowed(counts, needs, by)
    order = Window.partitionBy(*by, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_to", F.sum("_c").over(order))
    at = beside(needs, placed, [*by, "_i"])
    return at.filter(F.col("_to") > F.col("_k")).groupBy(*by, "n", "_name").agg(F.min("_v").alias("_v"))


def _narrowed(counts: DataFrame, needs: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """*counts* with nothing but the step of a grid of its values in which a rank lies, and *needs* with ranks from there.

    Steps part different values, so repeated ones don't hinder; each rank becomes a bracket of its own.
    """
    key = [*by, "_i"]
    steps = counts.groupBy(*key).agg(F.percentile_approx("_v", [i / STEPS for i in range(1, STEPS)], ACCURACY).alias("_g"))
    stepped = beside(counts, steps, key).withColumn("_s", F.size(F.filter("_g", lambda g: g < F.col("_v")))).drop("_g")
    sums = stepped.groupBy(*key, "_s").agg(F.sum("_c").alias("_n"))
    upto = sums.withColumn("_to", F.sum("_n").over(Window.partitionBy(*key).orderBy("_s").rowsBetween(Window.unboundedPreceding, 0)))  # STEPS rows a bracket
    own = beside(needs, upto, key).filter((F.col("_to") > F.col("_k")) & (F.col("_to") - F.col("_n") <= F.col("_k")))
    names = F.col("_name")
    chosen = stash(own.select(*by, "n", "_i", names, (F.col("_k") - F.col("_to") + F.col("_n")).alias("_k"), "_s"))
    kept = stepped.withColumnRenamed("_c", "_count")
    steps_of = chosen.select(*key, "_s", F.col("_name").alias("_i2"))
    left = stash(beside(kept, steps_of, [*key, "_s"]).select(*by, F.col("_i2").alias("_i"), "_v", F.col("_count").alias("_c")))
    return left, chosen.select(*by, "n", F.col("_name").alias("_i"), "_name", "_k")


def nearest(df: DataFrame, value: str, quantiles: dict[str, float | Column], by: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """One row a group: n and a column for each quantile, the value of rank floor(q (n - 1) + 0.5).

    Exact, see :func:`_ranked`.  Nulls don't count.  A quantile may be a column of *known*, the
    :func:`grid` of the same rows (with columns of the group beside it).
    """
    share = {name: q if isinstance(q, Column) else F.lit(float(q)) for name, q in quantiles.items()}
    return _ranked(df, value, {name: (q, {name: F.floor(q * (F.col("n") - 1) + 0.5)}) for name, q in share.items()}, by or [], known if known is not None else grid(df, value, by))


def linear(df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """One row a group: n and quantiles interpolated between the values of the ranks beside q (n - 1); exact, as :func:`nearest` is.

    Without any value there is no row of a group, and one with n = 0 and nulls of the whole.
    """
    by, wanted = by or [], {}
    for name, q in quantiles.items():
        at = F.lit(float(q)) * (F.col("n") - 1)
        wanted[name] = (F.lit(float(q)), {f"_below_{name}": F.floor(at), f"_above_{name}": F.ceil(at)})
    out = _ranked(df.withColumn(value, F.col(value).cast("double")), value, wanted, by, grid(df, value, by))
    part = {name: F.lit(float(q)) * (F.col("n") - 1) - F.floor(F.lit(float(q)) * (F.col("n") - 1)) for name, q in quantiles.items()}
    return out.select(*by, F.coalesce("n", F.lit(0)).alias("n"), *[(F.col(f"_below_{name}") + part[name] * (F.col(f"_above_{name}") - F.col(f"_below_{name}"))).alias(name) for name in quantiles])


def approximate(df: DataFrame, value: str, quantiles: dict[str, float], by: list[str] | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """One row a group: n and quantiles by sketches of fixed size, where the nearest of about n / accuracy ranks will do."""
    names = list(quantiles)
    out = df.groupBy(*(by or [])).agg(F.count(value).alias("n"), F.percentile_approx(value, [float(q) for q in quantiles.values()], accuracy).alias("_q"))
    return out.select(*(by or []), "n", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(names)])
