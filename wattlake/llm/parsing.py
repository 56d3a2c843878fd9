"""Document fingerprints by locally consistent parsing with deterministic coin tossing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of a fingerprint, 16 bits each.
SLOTS = 128
#: Phrases count from this level on, in texts of any length (about three characters a level, each three times the one below).
LEVEL = 2
#: Code points that are parsed side by side.
AT_ONCE = 400_000
#: Rows alike that a task writes out together.
ALIKE = 256
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing: twice the lowest bit in which a name differs from its left neighbour, plus that bit."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[first] = names[first] ^ np.asarray(1, names.dtype)
    differ = names ^ left
    low = differ & (~differ + np.asarray(1, names.dtype))
    bit = np.bitwise_count(low - np.asarray(1, names.dtype))
    return (2 * bit + ((names & low) != 0)).astype(np.uint8)


def _phrases(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the next level, and the text that each belongs to.

    Runs of one name become one; then neighbours differ, coin tossing gives labels under 6 that
    differ too, and a phrase begins at each local maximum.  That depends on a few neighbours
    only, so equal stretches have equal phrases but for some at their ends.
    """
    new = np.empty(len(names), bool)
    new[0] = True
    new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(names)))
    names, owner = np.where(run > 1, _mix(names[at] + run.astype(np.uint64) * _A), names[at]), owner[at]
    first = np.empty(len(names), bool)
    first[0] = True
    first[1:] = owner[1:] != owner[:-1]
    label = _toss(names, first)
    for _ in range(3):
        label = _toss(label, first)
    begins = np.zeros(len(names), bool)
    begins[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    # the second and the last name of a text begin nothing, so every phrase has two names at least
    begins[1:] &= ~first[:-1]
    begins[:-1] &= ~first[1:]
    begins |= first
    at = np.flatnonzero(begins)
    place = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
    return _mix(np.add.reduceat(_mix(names ^ (place.astype(np.uint64) + np.uint64(1)) * _A), at)), owner[at]


def signatures(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level the phrase names of all *texts* and the index of the text of each."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    names, owner = _mix(code + np.uint64(1)), np.repeat(np.arange(len(texts)), size)
    out = []
    while len(names):
        names, owner = _phrases(names, owner)
        out.append((names, owner))
        alone = np.bincount(owner, minlength=len(texts)) == 1
        names, owner = names[~alone[owner]], owner[~alone[owner]]
    return out


def sketch(texts: list[str]) -> np.ndarray:
    """(texts, SLOTS) of uint16: of each slot the least phrase name in it, 0 if it has none."""
    best = np.full(len(texts) * SLOTS, np.iinfo(np.uint64).max, np.uint64)
    levels = signatures(texts)
    top = np.zeros(len(texts), np.int64)
    for level, (_, owner) in enumerate(levels, 1):
        top[owner] = level
    for level, (names, owner) in enumerate(levels, 1):
        # what is shorter than its level has its whole phrase alone
        use = level >= np.minimum(LEVEL, top)[owner]
        slot = owner[use] * SLOTS + (names[use] >> np.uint64(57)).astype(np.int64)
        np.minimum.at(best, slot, names[use] & np.uint64((1 << 57) - 1))
    low = (best & np.uint64(0xFFFF)).astype(np.uint16)
    return np.where(best == np.iinfo(np.uint64).max, 0, np.maximum(low, 1)).astype(np.uint16).reshape(len(texts), SLOTS)


def fingerprints(texts: list[str]) -> list[str]:
    """The sketches as lowercase hex digits; equal texts have equal fingerprints."""
    out: list[str] = []
    lot: list[str] = []
    size = 0
    for i, t in enumerate(texts):
        lot.append(t)
        size += len(t)
        if size >= AT_ONCE or i == len(texts) - 1:
            out += [row.astype(">u2").tobytes().hex() for row in sketch(lot)]
            lot, size = [], 0
    return out


def likeness(a: str, b: str) -> float:
    """Share of the slots in use that agree, 0 to 1: an estimate of how many phrases two texts share; two empty texts: 1."""
    x, y = np.frombuffer(bytes.fromhex(a), ">u2"), np.frombuffer(bytes.fromhex(b), ">u2")
    used = (x != 0) | (y != 0)
    return float(((x == y) & used).sum() / used.sum()) if used.any() else 1.0


def with_fingerprint(documents: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint of every whole text (null: that of the empty text)."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(fingerprints([t or "" for t in batch]), index=batch.index, dtype=object)

    return documents.withColumn(out_col, run(F.col(text_col)))


def edited(text: str, following: str) -> str:
    """*text* with its last half (rounded down) replaced by the first as many code points of *following*, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _cuts(spread: list[int] | None) -> list[int]:
    """Where ranges of ids begin, ascending; an id that fills several steps of *spread* is a range of its own."""
    spread = spread or []
    often = {c for c, d in zip(spread, spread[1:], strict=False) if c == d}
    return sorted({*spread, *(c + 1 for c in often if c < (1 << 63) - 1)})


def _dealt(ranges: list[tuple[int, bool, int]], parts: int) -> tuple[list[int], list[int]]:
    """For each range its first task, and how many tasks it has; *ranges*: (number, of one id, bytes) in order.

    Ranges follow one another into tasks of about a *parts*-th of all bytes; only one with a
    single id can have several tasks.
    """
    target = max(1, sum(size for _, _, size in ranges) // parts)
    first, count = [0] * (max(r[0] for r in ranges) + 1), [1] * (max(r[0] for r in ranges) + 1)
    task, held = 0, 0
    for number, one, size in ranges:
        several = -(-size // target) if one else 1
        if held and (held + size > target or several > 1):
            task, held = task + 1, 0
        first[number], count[number] = task, several
        held += size
        if several > 1:
            task, held = task + several, 0
    return first, count


def against_next(documents: DataFrame, per_task: int = 8) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are to it and to the next document.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.)
    The next document is the one after in order of doc_id (null first; equal ids in order of a
    hash of the text, then of the text), the first after the last.  Documents are dealt to tasks
    by ranges of doc_id, about *per_task* to a task, so that tasks have like numbers of bytes; an
    id with very many rows has tasks of its own, by the hash, and rows of it with the same text are
    read as one.  The first row of each task is copied to the task before; so texts are shuffled once and no task sees more than its ranges.
    Null texts count as empty.  An empty table gives no rows.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_h", F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    steps = parts * per_task
    cuts = _cuts(rows.agg(F.percentile_approx("doc_id", [i / steps for i in range(1, steps)], 10_000)).first()[0])
    number = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c <= F.col("doc_id"))))
    rows = rows.withColumn("_r", number).withColumn("_n", F.lit(1).cast("long"))
    # a row for each range comes to the driver, then one for each task
    bounds = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum(F.octet_length("text") + F.lit(64)).alias("size")]
    found = sorted(rows.groupBy("_r").agg(*bounds).collect(), key=lambda r: r["_r"])
    if not found:
        return spark.createDataFrame([], SCHEMA)
    one = lambda r: r["low"] == r["high"]
    first, count = _dealt([(r["_r"], one(r), r["size"]) for r in found], parts)
    often = [i for i, c in enumerate(count) if c > 1]
    if often:  # an id with very many rows: those alike are one row with a number, as each but the last is followed by its like
        alike = rows.filter(F.col("_r").isin(often)).groupBy("doc_id", "text", "_h", "_r").agg(F.count("*").alias("_n"))
        rows = rows.filter(~F.col("_r").isin(often)).unionByName(alike)
        again = {r["_r"]: r for r in alike.groupBy("_r").agg(*bounds).collect()}
        found = [again.get(r["_r"], r) for r in found]
        first, count = _dealt([(r["_r"], one(r), r["size"]) for r in found], parts)
    within = F.shiftright(F.col("_h") * F.get(F.array(*map(F.lit, count)), F.col("_r")), 32)
    rows = rows.withColumn("_to", (F.get(F.array(*map(F.lit, first)), F.col("_r")) + within).cast("int"))
    tasks = sorted(r[0] for r in rows.select("_to").distinct().collect()) if max(count) > 1 else sorted({first[r["_r"]] for r in found})
    before = dict(zip(tasks, [tasks[-1], *tasks[:-1]], strict=True))
    # the first row of a task is of its first id, or else of a part of an id that has several tasks
    low = {first[r["_r"]]: r["low"] for r in reversed(found)}
    heads = F.col("doc_id").isin([x for x in low.values() if x is not None]) | F.col("doc_id").isNull()
    copies = rows.filter(heads).groupBy("_to").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "_h", "text")).alias("_f"))
    back = F.get(F.array(*[F.lit(before.get(t, 0)) for t in range(tasks[-1] + 1)]), F.col("_to"))
    copies = copies.select("_f.doc_id", "_f.text", "_f._h", F.lit(1).cast("long").alias("_n"), back.alias("_to"), F.lit(True).alias("_x"))
    dealt = rows.select("doc_id", "text", "_h", "_n", "_to", F.lit(False).alias("_x")).unionByName(copies)
    dealt = dealt.repartitionById(tasks[-1] + 1, F.col("_to")).sortWithinPartitions("_x", F.col("doc_id").asc_nulls_first(), "_h", "text")
    # with the nulls apart, ids stay whole numbers in pandas
    dealt = dealt.select(F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), "text", "_n")

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """(row, the one after it, how often); the last of a task is the copy, which has none."""
        held = None
        for batch in batches:
            for id_, none, text, n in batch.itertuples(index=False, name=None):
                row = (None if none else id_, text)
                if held is not None:
                    yield held, row, 1
                if n > 1:
                    yield row, row, n - 1
                held = row

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lot, size = [], 0
        for pair in pairs(batches):
            lot.append(pair)
            size += 2 * len(pair[0][1])
            if size >= AT_ONCE:
                yield digest(lot)
                lot, size = [], 0
        if lot:
            yield digest(lot)

    def digest(lot: list) -> pd.DataFrame:
        # a text is parsed once, though it is also the next of the row before
        own, after = [], []
        for i, (row, following, _) in enumerate(lot):
            after.append(len(own) + 1)
            own.append(row[1])
            if i + 1 == len(lot) or lot[i + 1][0] is not following:
                own.append(following[1])
        found, changed = fingerprints(own), [edited(row[1], following[1]) for row, following, _ in lot]
        mine, other, later = [found[i - 1] for i in after], fingerprints(changed), [found[i] for i in after]
        return pd.DataFrame({
            "doc_id": pd.array([row[0] for row, *_ in lot], dtype="Int64"), "n_chars": [len(row[1]) for row, *_ in lot],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            "fingerprint": mine, "edited_fingerprint": other,
            "near_edited": [likeness(a, b) for a, b in zip(mine, other, strict=True)], "near_next": [likeness(a, b) for a, b in zip(mine, later, strict=True)],
            "_n": [n for *_, n in lot],
        })

    made = dealt.mapInPandas(run, SCHEMA + ", _n long")
    if not often:
        return made.drop("_n")
    spread = made.withColumn("_j", F.explode(F.expr(f"sequence(0L, (_n - 1) div {ALIKE})"))).repartition(parts, "doc_id", "edited_sha256", "_j")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ALIKE).cast("long"), F.col("_n") - F.col("_j") * ALIKE)))
    return spread.withColumn("_e", each).select(made.drop("_n").columns)
