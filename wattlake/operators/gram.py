"""Means and products of many columns in one look at the rows, whole or for each of many segments; what follows from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers that a task holds before it hands on what it has summed so far.
HELD = 8_000_000
#: Columns of which :func:`lines` has each pair as an aggregate of Spark's own; more are summed in matrix products.
NARROW = 12
FIELDS = ("n", "mean_x", "mean_y", "xx", "yy", "xy")
SCHEMA = "segment string, i int, " + ", ".join(f"{f} array<double>" for f in FIELDS)


class _Sums:
    """Sums of one segment's rows about a shift near their means: counts, sums and products of all pairs of columns."""

    def __init__(self, block: np.ndarray):
        mask = ~np.isnan(block)
        self.shift = np.where(mask, block, 0).sum(0) / np.maximum(mask.sum(0), 1)
        self.n, self.x, self.xx, self.xy = (np.zeros((block.shape[1],) * 2) for _ in range(4))

    def add(self, block: np.ndarray) -> None:
        there = ~np.isnan(block)
        mask, block = there.astype(float), np.where(there, block - self.shift, 0.0)
        self.n += mask.T @ mask
        self.x += block.T @ mask
        self.xx += (block * block).T @ mask
        self.xy += block.T @ block

    def rows(self) -> tuple[np.ndarray, ...]:
        n = np.maximum(self.n, 1)
        xx = np.maximum(self.xx - self.x**2 / n, 0)
        return self.n, self.x / n + self.shift[:, None], self.x.T / n + self.shift[None, :], xx, xx.T, self.xy - self.x * self.x.T / n


def moments(df: DataFrame, columns: list[str], segment: str | None = None) -> DataFrame:
    """(segment, i, n, mean_x, mean_y, xx, yy, xy): for column i and, in arrays, each column j, over the rows that have both.

    xx, yy and xy are sums of products about the means; null and NaN are no values.  A task sums
    what it reads in matrix products and hands on a row a segment and column; these meet by
    segment and column, so neither many rows, columns nor segments meet in one task.  The plan is
    the same for any number of columns.
    """
    k = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, _Sums] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for name, sums in held.items():
                made = [pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).ravel()), k).cast(pa.list_(pa.float64())) for x in sums.rows()]
                yield pa.RecordBatch.from_arrays([pa.array([name] * k, pa.string()), pa.array(range(k), pa.int32()), *made], ["segment", "i", *FIELDS])
            held.clear()

        for batch in batches:
            block = np.column_stack([batch[f"c{i}"].to_numpy(zero_copy_only=False) for i in range(k)]).astype(float)
            codes, names = pd.factorize(batch["segment"].to_numpy(zero_copy_only=False), use_na_sentinel=False)
            order = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[order], np.arange(len(names) + 1))
            for name, a, b in zip(names, cuts[:-1], cuts[1:], strict=True):
                own, name = block[order[a:b]], None if pd.isna(name) else name
                if name not in held:
                    if (len(held) + 1) * 4 * k * k > HELD:
                        yield from handed()
                    held[name] = _Sums(own)
                held[name].add(own)
        yield from handed()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        n, mx, my, xx, yy, xy = (np.stack(group[f].to_numpy()) for f in FIELDS)
        total = n.sum(0)
        some = np.maximum(total, 1)
        x, y = (n * mx).sum(0) / some, (n * my).sum(0) / some
        dx, dy = mx - x, my - y
        sums = total, x, y, (xx + n * dx * dx).sum(0), (yy + n * dy * dy).sum(0), (xy + n * dx * dy).sum(0)
        return pd.DataFrame({"segment": group["segment"].iloc[:1], "i": group["i"].iloc[:1]} | {f: [s.tolist()] for f, s in zip(FIELDS, sums, strict=True)})

    name = F.col(segment).cast("string") if segment else F.lit("").cast("string")
    rows = df.select(name.alias("segment"), *[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    return rows.mapInArrow(run, SCHEMA).groupBy("segment", "i").applyInPandas(merge, SCHEMA)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, n, r) of each two columns: Pearson's r over the rows that have both; null where one of them is constant there."""
    names = F.array(*[F.lit(c) for c in columns])
    pairs = moments(df, columns).select("i", F.posexplode(F.arrays_zip("n", "xx", "yy", "xy")).alias("j", "_m")).filter("i < j")
    r = F.try_divide(F.col("_m.xy"), F.sqrt(F.col("_m.xx") * F.col("_m.yy")))
    return pairs.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), F.col("_m.n").cast("long").alias("n"), r.alias("r"))


def _of_pairs(df: DataFrame, columns: list[str], segment: str | None) -> DataFrame:
    """(segment, n, mean, xy): means and, row by row, covariances of a few columns without gaps, as aggregates that hold a segment's numbers only."""
    name = F.col(segment).cast("string") if segment else F.lit("").cast("string")
    c = [F.col(f"c{i}") for i in range(len(columns))]
    pairs = {(i, j): F.var_pop(c[i]) if i == j else F.covar_pop(c[i], c[j]) for i in range(len(c)) for j in range(i + 1)}
    rows = df.select(name.alias("segment"), *[F.col(f"`{x}`").cast("double").alias(f"c{i}") for i, x in enumerate(columns)])
    found = rows.groupBy("segment").agg(F.count("*").alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(c)], *[p.alias(f"p{i}_{j}") for (i, j), p in pairs.items()])
    xy = [F.col(f"p{max(i, j)}_{min(i, j)}") for i in range(len(c)) for j in range(len(c))]
    return found.select("segment", "n", F.array(*[f"m{i}" for i in range(len(c))]).alias("mean"), F.array(*xy).alias("xy"))


def _of_products(df: DataFrame, columns: list[str], segment: str | None) -> DataFrame:
    """What :func:`_of_pairs` gives, of any number of columns, from :func:`moments`; xy are sums of products rather than their means."""
    k = len(columns) - 1
    by_column = F.array_sort(F.collect_list(F.struct("i", F.get("n", F.lit(k)).alias("n"), F.get("mean_x", F.lit(k)).alias("mean"), "xy")))
    found = moments(df, columns, segment).groupBy("segment").agg(by_column.alias("_c"))
    return found.select("segment", F.get("_c.n", F.lit(0)).cast("long").alias("n"), F.col("_c.mean").alias("mean"), F.flatten("_c.xy").alias("xy"))


def lines(df: DataFrame, features: list[str], target: str, segment: str | None = None) -> DataFrame:
    """(segment, n, intercept, coefficients): least squares of *target* on *features*, all segments in one look at the rows.

    Rows that lack a feature or the target are left out; a segment with none has no line.  Where
    features depend on each other (or are constant) the shortest solution is taken, which
    predicts the same on such rows.  Segments are solved a batch at once.
    """
    k = len(features)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            mean = batch["mean"].flatten().to_numpy().reshape(-1, k + 1)
            xy = batch["xy"].flatten().to_numpy().reshape(-1, k + 1, k + 1)
            own = np.diagonal(xy, axis1=1, axis2=2)[:, :k]
            spread = np.sqrt(np.where(own > 0, own, 1))
            inverse = np.linalg.pinv(xy[:, :k, :k] / (spread[:, :, None] * spread[:, None, :]), rcond=1e-12, hermitian=True)
            found = (inverse @ (xy[:, :k, k] / spread)[:, :, None])[:, :, 0] / spread
            at = mean[:, k] - (found * mean[:, :k]).sum(1)
            coefficients = pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(found).ravel()), k).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["segment"], batch["n"], pa.array(at), coefficients], ["segment", "n", "intercept", "coefficients"])

    columns = [*features, target]
    whole = df.filter(" and ".join(f"`{c}` is not null and not isnan(`{c}`)" for c in columns))
    sums = (_of_pairs if len(columns) <= NARROW else _of_products)(whole, columns, segment)
    return sums.mapInArrow(solve, "segment string, n long, intercept double, coefficients array<double>")
