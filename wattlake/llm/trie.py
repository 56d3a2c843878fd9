"""Conversation prefix trie: count-min screening of prefix digests, exact grouping of what may be shared."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from wattlake.llm.common import Shared, forget, stash

#: Cells of each of the sketch's rows; beyond MOST fewer prefixes are proven single, and more are grouped exactly.
LEAST_CELLS, MOST_CELLS = 1 << 12, 1 << 24
#: Rows (hash functions) of the sketch, and the cells of a block in which it is summed.
LANES, BLOCK = 4, 1 << 12
#: A conversation's base is the one with the next lower id that this divides; it lends up to three turns.
FAMILY, MOST_LENT = 20, 4
NODE = ["depth", "k1", "k2"]
NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words) of every turn: its place from 1, SHA-256 of role and text, words of the text.

    Turns go by ``turn`` (null first), then by digest.  Null roles and texts are empty.  Rows
    without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "digest", "words")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "digest", "words")


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their :func:`turns` after the first h were taken from the family's base.

    Conversation c gets the first h = crc32(c) % 4 turns of c - c % 20 (all if it has fewer,
    none if it's absent), then its own turns after its first h.  *own* is read three times.
    """
    base, h = F.col("conv_id") - F.col("conv_id") % FAMILY, F.crc32(F.col("conv_id").cast("string")) % MOST_LENT
    lent = own.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < MOST_LENT)).select(F.col("conv_id").alias("base"), "pos", "digest", "words")
    lengths = own.groupBy("conv_id").agg(F.count("*").alias("n")).select("conv_id", "n", base.alias("base"), h.alias("h"))
    lengths = lengths.join(lent.groupBy("base").agg(F.count("*").alias("has")), "base", "left")
    taken = F.least("h", F.coalesce("has", F.lit(0)))
    plans = stash(lengths.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length")))
    rest = own.join(plans, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    first = plans.filter("taken > 0").join(lent, "base").filter("pos <= taken").select("conv_id", "pos", "digest", "words")
    return plans.select("conv_id", "length"), rest.unionByName(first)


def prefixes(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, length, depth, k1, k2, words): a row for each prefix, from the empty one; k1 and k2 are its digest.

    A prefix's digest is the exclusive or of its turns' digests salted with their places, so it
    grows along a window that keeps no turns; equal sequences, and (at 128 bits) no others, agree.
    """
    so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    keys = [F.bit_xor(F.xxhash64(F.lit(salt), "pos", "digest")).over(so_far).alias(name) for salt, name in ((1, "k1"), (2, "k2"))]
    deep = rows.select("conv_id", F.col("pos").alias("depth"), *keys, "words")
    root = conversations.select("conv_id", *(F.lit(0).cast("long").alias(c) for c in (*NODE, "words")))
    return deep.unionByName(root).join(conversations, "conv_id")


def cells(k1: np.ndarray, k2: np.ndarray, width: int) -> np.ndarray:
    """The cell of each prefix in every row of the sketch, numbered through all rows."""
    a, b = k1.astype(np.uint64), k2.astype(np.uint64) | np.uint64(1)
    lanes = np.arange(1, LANES + 1, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        x = a + lanes * b
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)  # a multiplier of 64 bits, as hash finishers use
        x ^= x >> np.uint64(32)
    return ((x % np.uint64(width)) + (lanes - np.uint64(1)) * np.uint64(width)).astype(np.int64)


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """The count-min sketch of *rows* (k1, k2) as far as screening needs it: whether a cell counts two or more.

    Counts stop at two.  A task sums its own rows, then each block of cells is summed as it
    comes in, whatever the number of tasks; the driver gets ``LANES * width`` bits.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(LANES * width, dtype=np.uint8)
        for batch in batches:
            at, n = np.unique(cells(batch["k1"].to_numpy(), batch["k2"].to_numpy(), width), return_counts=True)
            held[at] = np.minimum(held[at] + np.minimum(n, 2), 2)
        held = held.reshape(-1, BLOCK)
        for at in np.flatnonzero(held.any(1)).tolist():
            yield pa.RecordBatch.from_pydict({"block": pa.array([at], pa.int64()), "counts": pa.array([held[at].tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist(), strict=True):
                sums[at] = np.minimum(sums.get(at, 0) + np.frombuffer(counts, np.uint8), 2)
        for at, counts in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([at], pa.int64()), "counts": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})

    schema = "block long, counts binary"
    full = np.zeros((LANES * width // BLOCK, BLOCK // 8), dtype=np.uint8)
    for r in rows.select("k1", "k2").mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect():
        full[r["block"]] = np.frombuffer(r["counts"], np.uint8)
    return full.ravel()


def may_be_shared(full: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Whether the sketch estimates two or more: where any of its cells counts one, the prefix has one conversation."""
    at = cells(k1, k2, len(full) * 8 // LANES)
    return ((full[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool).all(0)


def nodes(rows: DataFrame) -> DataFrame:
    """The trie's nodes of :func:`prefixes`: see :func:`trie`.

    Prefixes that the sketch proves single, and all that follow them, are nodes with one member
    and are emitted as they stand.  The others are grouped by digest; what a node's subtree holds
    is summed by letting its smallest member carry it, so depth costs no rounds.
    """
    spark = rows.sparkSession
    kept = stash(rows)
    size = kept.count()
    width = min(MOST_CELLS, max(LEAST_CELLS, 1 << (4 * size).bit_length()))
    full = Shared(spark, sketch(kept.filter("depth > 0"), width))

    @F.pandas_udf(BooleanType())
    def shared(k1, k2):
        import pandas as pd

        return pd.Series(may_be_shared(full.get(), k1.to_numpy(), k2.to_numpy()))

    by_conv = Window.partitionBy("conv_id").orderBy("depth")
    flagged = kept.withColumn("_alone", (F.col("depth") > 0) & ~shared("k1", "k2"))
    flagged = stash(flagged.withColumn("_alone", F.count_if("_alone").over(by_conv)))  # counts on from the first that is
    some = flagged.filter("_alone = 0")
    end = F.col("depth") == F.col("length")
    found = stash(some.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("rep"), F.count_if(end).alias("n_ends")))
    joined = stash(some.select("conv_id", "length", *NODE, "words").join(found, NODE))

    starts = flagged.filter("_alone >= 1").groupBy("conv_id").agg(F.min("depth").alias("depth"))
    zero = F.lit(0).cast("long")
    tails = starts.select("conv_id", zero.alias("length"), "depth", zero.alias("k1"), zero.alias("k2"), zero.alias("words"), F.lit(1).cast("long").alias("n_convs"), F.col("conv_id").alias("rep"), zero.alias("n_ends"), F.lit(True).alias("tail"))
    along = joined.withColumn("tail", F.lit(False)).unionByName(tails)
    first = F.col("rep") == F.col("conv_id")
    leaf = F.when(F.col("tail") | (first & (F.col("n_ends") == F.col("n_convs"))), 1).otherwise(0)
    saved = F.when(first, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)
    below = by_conv.rowsBetween(0, Window.unboundedFollowing)
    carried = stash(along.select(
        "*", F.lag("rep").over(by_conv).alias("parent"), F.lead(first.cast("long")).over(by_conv).alias("child"),
        F.sum(leaf).over(below).alias("leaves"), F.sum(saved).over(below).alias("saved"),
    ))

    several = ends(joined.filter((F.col("n_ends") > 1) & end))
    met = carried.filter("not tail").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent_conv_id"), F.max("n_convs").alias("n_convs"),
        F.coalesce(F.sum("child"), zero).alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"),
        F.max(F.when(end, F.col("conv_id"))).alias("_end"),
    ).join(several, NODE, "left")
    own = F.sha2(F.coalesce(F.col("_end").cast("string"), F.lit("")), 256)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    met = met.withColumn("ends_sha256", F.coalesce("sha", own)).select(columns)
    one = F.lit(1).cast("long")
    alone = flagged.filter("_alone >= 1").join(carried.filter("tail").select("conv_id", F.col("depth").alias("_first"), "parent"), "conv_id").select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("_first"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), one.alias("n_convs"),
        F.when(end, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(end, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    out = stash(met.unionByName(alone))
    forget(kept, flagged, found, joined, carried)
    return out


def ends(rows: DataFrame) -> DataFrame:
    """(depth, k1, k2, sha): SHA-256 of each node's conv_ids, ascending, joined with commas.

    Ids are sorted by ranges over all tasks and joined to pieces there; a node's digest then
    takes its pieces one by one, so no task holds a node's ids.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.stack([batch[c].to_numpy() for c in NODE])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
            ids = batch["conv_id"].to_pylist()
            spans = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
            columns = {c: key[i, [a for a, _ in spans]] for i, c in enumerate(NODE)}
            yield pa.RecordBatch.from_pydict(columns | {"first": [ids[a] for a, _ in spans], "piece": [",".join(map(str, ids[a:b])) for a, b in spans]})

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def done():
            return pa.RecordBatch.from_pydict({c: pa.array([v], pa.int64()) for c, v in zip(NODE, now, strict=True)} | {"sha": [held.hexdigest()]})

        for batch in batches:
            for *key, piece in zip(*(batch[c].to_pylist() for c in NODE), batch["piece"].to_pylist(), strict=True):
                if key == now:
                    held.update(b",")
                else:
                    if now:
                        yield done()
                    now, held = key, hashlib.sha256()
                held.update(piece.encode())
        if now:
            yield done()

    spread = rows.select(*NODE, "conv_id").repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    parts = spread.mapInArrow(pieces, "depth long, k1 long, k2 long, first long, piece string")
    return parts.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "depth long, k1 long, k2 long, sha string")


def trie(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The prefix trie of *conversations* (conv_id, length) with the turns *rows* (conv_id, pos, digest, words).

    A row for each distinct sequence of first turns, the empty one (depth 0) included: conv_id (the
    smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves
    and saved_tokens of the subtree, ends_sha256.  Without conversations there is no node.
    """
    return nodes(prefixes(conversations, rows))


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """:func:`trie` of the :func:`rebuilt` conversations of a table (conv_id, turn, role, text)."""
    own = stash(turns(conversations))
    found = trie(*rebuilt(own))
    forget(own)
    return found
