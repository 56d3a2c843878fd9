"""Embedding near-dedup: spherical k-means cells, blocked cosine products within and between them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import Shared, forget, stash
from wattlake.llm.graph import MinForest, components

#: Vectors a cell in the mean, most cells, expected vectors that the cells are fitted on, rounds of the fit.
PER_CELL, MOST_CELLS, SAMPLE, ROUNDS = 1000, 4096, 40_000, 8
#: For callers who give up pairs for speed: how far apart across the plane between their cells the vectors of a pair may be, in deviations of a pair's offset there.
REACH = 3.0
#: Bytes of a block's vectors, less than twice as many where a task has more; rows of a result that a task gathers before it sums them up; pairs that are decided in double precision at once.
BLOCK, GATHERED, LOT = 1 << 22, 1_000_000, 16_384
#: What components are kept as, by their type in Spark.
KINDS = {"float": np.float32, "double": np.float64}


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision."""
    small, x = x.dtype == np.float32, x.astype(float)
    if not small:  # squares of double numbers could overflow or vanish
        x /= np.abs(x).max(1, keepdims=True)
    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return x


def _matrix(vectors: pd.Series, width: int, kind: str) -> np.ndarray:
    """The vectors as rows; a shorter one is filled up with zeros."""
    out = np.zeros((len(vectors), width), KINDS[kind])
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def fit_cells(sample: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """*k* directions (fewer if the sample is smaller) by spherical k-means; deterministic."""
    rng = np.random.default_rng(seed)
    centre = sample[rng.permutation(len(sample))[:k]].copy()
    for _ in range(ROUNDS):
        home = np.concatenate([(sample[i : i + 4096] @ centre.T).argmax(1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(centre)
        np.add.at(total, home, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centre = np.where(size > 1e-9, total / np.maximum(size, 1e-9), centre)
    return centre


def _towards(home: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Directions of length 1 from each of *others* to the centre *home*, across the plane between them (zero if they are the same)."""
    to = home - others
    length = np.linalg.norm(to, axis=1, keepdims=True)
    return to / np.where(length > 0, length, 1)


def _slack(width: int) -> float:
    """More than what products of two unit vectors in single precision, or sums of two such products, are wrong by."""
    return (width + 8) * 2.0**-23


def _near(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], x_off: np.ndarray, y_off: np.ndarray, apart: float, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (rows of *x*, rows of *y*) with a cosine of *least* or more, whose offsets from the plane between their cells sum up to *apart* at most.

    *x* and *y* are unit vectors in double and in single precision.  Products of the latter settle
    all pairs but those nearer to *least* than these can err; those are decided by the former,
    each by itself.
    """
    slack = _slack(x[0].shape[1])
    i_at, j_at = np.argsort(x_off), np.argsort(y_off)
    few, many, y_off = x[1][i_at], y[1][j_at], y_off[j_at]
    reached = np.searchsorted(y_off, apart - x_off[i_at[::256]], "right")
    for at, to in ((256 * k, to) for k, end in enumerate(reached) for to in range(0, end, 4096)):
        cos = few[at : at + 256] @ many[to : min(to + 4096, reached[at // 256])].T
        if cos.max() < least - slack:
            continue
        i, j = np.nonzero(cos >= least - slack)
        unsure = np.flatnonzero(cos[i, j] < least + slack)
        i, j = i_at[i + at], j_at[j + to]
        linked = np.ones(len(i), bool)
        for k in range(0, len(unsure), LOT):
            lot = unsure[k : k + LOT]
            linked[lot] = np.einsum("ij,ij->i", x[0][i[lot]], y[0][j[lot]]) >= least
        yield i[linked], j[linked]


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (a, b, links) a row for each a: the smallest id that its links lead to, and the sum."""
    a, b, links = (np.concatenate(x) for x in zip(*parts, strict=True))
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    forest, total = MinForest(len(ids)), np.zeros(len(ids), np.int64)
    np.add.at(total, at[: len(a)], links)
    forest.link(at[: len(a)], at[len(a) :])
    return ids, ids[forest.find(np.arange(len(ids)))], total


def near_components(vectors: DataFrame, least: float = 0.9, per_cell: int = PER_CELL, reach: float | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of *vectors* (vec_id, embedding).

    Vectors link if their cosine in double precision is *least* or more; n_links counts the other
    rows linked directly, component_id is the smallest vec_id that links lead to, kept says that
    it is the row's own.  Vectors that are null, zero, or hold null or non-finite components link
    with nothing, nor do rows without a vec_id, which others' n_links don't count.  Vectors of
    unequal length compare as if filled up with zeros.  Equal vectors are compared once and
    counted by their number.  The cells are fitted on a bounded sample; every vector is placed in
    the nearest, and blocks of cells are compared wherever a pair can lie in them, which gives
    every pair; a *reach* compares fewer and can miss some, see :func:`_linked`.
    """
    spark = vectors.sparkSession
    kind = "float" if dict(vectors.dtypes)["embedding"] == "array<float>" else "double"
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    # a vector's name: later steps pass on these 128 bits rather than the vector
    rows = rows.withColumns({f"k{i}": F.when(sound, F.xxhash64(F.lit(i), "embedding")) for i in (0, 1)})
    named = stash(rows.select("vec_id", "k0", "k1"))
    # one row for each different vector, under the least id of its copies
    distinct = stash(rows.filter("k0 is not null").groupBy("k0", "k1", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    n, width = distinct.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if n:
        share = min(1_000_000, int(1_000_000 * SAMPLE / n) + 1)
        sample = distinct.filter(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < share).select("embedding").toPandas()["embedding"]
        centre = fit_cells(_unit(_matrix(sample, width, kind)), max(1, min(MOST_CELLS, n // per_cell)))
        found = _linked(distinct, centre, width, kind, least, reach)
    else:
        found = stash(spark.createDataFrame([], "a long, b long, links long"))
    group = components(found.select("a", "b"))
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    classes = (
        distinct.select("k0", "k1", "rep", "n").join(links, F.col("rep") == F.col("a"), "left").join(group, F.col("rep") == F.col("node"), "left")
        .select("k0", "k1", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    )
    placed = named.filter("k0 is not null").join(classes, ["k0", "k1"]).select("vec_id", "n_links", "component_id")
    alone = named.filter("k0 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(distinct: DataFrame, centre: np.ndarray, width: int, kind: str, least: float, reach: float | None) -> DataFrame:
    """(a, b, links): for vectors that a task has linked, what they lead to there and how many rows they link with.

    A row of the blocks has the vectors of a few cells, or some of a large one's.  The blocks are
    written once; tasks read partitions of them side by side, so no vector is copied for the cells
    that it is compared with, and the disk taken grows as the vectors do, however many pairs there are.

    If x and y have a cosine of *least* or more they are sqrt(2 - 2 least) apart at most, and so
    are their offsets from the plane between their home cells, which are on either side of it.
    Blocks or cells whose least offsets sum up to more hold no pair, and of others only those vectors
    are compared whose offsets don't; so with *reach* None no pair is lost.  If a pair's offset is
    spread evenly over all components, it is hardly ever more than a few times its deviation
    across any one plane, its length over the root of the number of components; *reach* is how
    many times.  Nothing bounds what that misses where offsets lie in few components.
    """
    shared = Shared(distinct.sparkSession, centre)
    apart = np.sqrt(2 - 2 * least)
    apart = float(apart if reach is None else min(apart, reach * apart / np.sqrt(width))) + _slack(width)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = shared.get()
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                yield part.assign(home=(_unit(_matrix(part["embedding"], width, kind)) @ cells.T).argmax(1).astype(np.int32))

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch) * width * KINDS[kind]().itemsize
            if size >= BLOCK:
                yield pd.concat(held)
                held, size = [], 0
        if size:
            yield pd.concat(held)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells = shared.get()
        for batch in gathered(batches):
            x = _matrix(batch["embedding"], width, kind)
            for at in np.array_split(np.arange(len(x)), max(1, x.nbytes // BLOCK)):
                home, ids, n = (batch[c].to_numpy()[at] for c in ("home", "rep", "n"))
                here, first, sizes = np.unique(home, return_index=True, return_counts=True)
                lots = ((h, x[at[k : min(k + 256, f + s)]]) for h, f, s in zip(here, first, sizes, strict=True) for k in range(f, f + s, 256))
                off = reduce(np.minimum, ((_unit(lot) @ _towards(cells[h], cells).T).min(0) for h, lot in lots))
                yield pd.DataFrame({"block": ids[:1], "cells": [here], "sizes": [sizes.astype(np.int32)], "off": [off.astype(np.float32)], "ids": [ids.tobytes()], "n": [n.tobytes()], "vectors": [x[at].tobytes()]})

    at_home = distinct.select("embedding", "rep", "n").mapInPandas(place, f"embedding array<{kind}>, rep long, n long, home int")
    by_home = at_home.repartitionByRange("home", F.xxhash64("rep")).sortWithinPartitions("home")
    blocks = stash(by_home.mapInPandas(pack, "block long, cells array<int>, sizes array<int>, off array<float>, ids binary, n binary, vectors binary"))
    left, right = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "xy")
    one, two = F.col("x_block"), F.col("y_block")
    # of two blocks one meets the other, which of them is left to a hash, so that tasks have like shares
    once = (one == two) | ((one < two) == (F.pmod(F.xxhash64(F.least(one, two), F.greatest(one, two)), F.lit(2)) == 0))
    near = F.array_min(F.transform("y_cells", lambda c: F.get("x_off", c))) + F.array_min(F.transform("x_cells", lambda c: F.get("y_off", c))) <= apart
    met = left.join(right.hint("shuffle_replicate_nl"), once & near).drop("x_off", "y_off")

    def opened(row: dict, side: str) -> tuple:
        ids, n = (np.frombuffer(row[f"{side}_{c}"], np.int64) for c in ("ids", "n"))
        unit = _unit(np.frombuffer(row[f"{side}_vectors"], KINDS[kind]).reshape(len(ids), width))
        ends = np.cumsum(row[f"{side}_sizes"])
        parts = [slice(e - s, e) for e, s in zip(ends, row[f"{side}_sizes"], strict=True)]
        return np.array(row[f"{side}_cells"]), parts, ids, n, unit, unit.astype(np.float32)

    def linked(one: tuple, two: tuple, centre: np.ndarray, same: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        (x_cells, x_parts, x_id, x_n, x, x32), (y_cells, y_parts, y_id, y_n, y, y32) = one, two
        found = []
        for a, b in ((a, b) for a in range(len(x_cells)) for b in range(a if same else 0, len(y_cells))):
            p, q = x_parts[a], y_parts[b]
            to_x = _towards(centre[x_cells[a]], centre[y_cells[b], None])[0].astype(np.float32)
            x_off, y_off = x32[p] @ to_x, -(y32[q] @ to_x)
            if x_off.min() + y_off.min() > apart:
                continue
            for i, j in _near((x[p], x32[p]), (y[q], y32[q]), x_off, y_off, apart, least):
                if same and a == b:  # each pair once
                    i, j = i[i < j], j[i < j]
                if not found:
                    ids = np.unique(np.concatenate((x_id, y_id)))
                    x_at, y_at = np.searchsorted(ids, x_id), np.searchsorted(ids, y_id)
                    forest, links = MinForest(len(ids)), np.zeros(len(ids), np.int64)
                    found = [(ids, forest, links)]
                i, j = i + p.start, j + q.start
                np.add.at(links, x_at[i], y_n[j])
                np.add.at(links, y_at[j], x_n[i])
                forest.link(x_at[i], y_at[j])
        return [(ids[some := np.flatnonzero(links)], ids[forest.find(some)], links[some]) for ids, forest, links in found]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, x, x_block = shared.get(), None, None
        parts, held = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch[name][k].as_py() for name in batch.schema.names}
                if x_block != row["x_block"]:  # the same for a run of rows
                    x, x_block = opened(row, "x"), row["x_block"]
                for some in linked(x, opened(row, "y"), cells, x_block == row["y_block"]):
                    parts.append(some)
                    held += len(some[0])
                if held > GATHERED:
                    parts = [_summed(parts)]
                    held = len(parts[0][0])
                    if held > GATHERED // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts.pop()], ["a", "b", "links"])
                        held = 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _summed(parts)], ["a", "b", "links"])

    found = stash(met.mapInArrow(compare, "a long, b long, links long"))
    forget(blocks)
    return found
