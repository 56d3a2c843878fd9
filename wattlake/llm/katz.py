"""LM scoring: Katz backoff over Good-Turing discounted word pairs, in tables partitioned by context."""

from __future__ import annotations

import gc
import math
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm.common import forget, stash

#: Counts up to KATZ are discounted.
KATZ = 5
#: Characters of a lot of texts; tokens that come to a part of the pair table; occurrences of a context that stay together.
LOT_CHARS, PART_TOKENS, HOT = 10_000_000, 1_000_000, 500_000
#: A word's id is that of its first lot, times this, plus its number there.
WORDS = 1 << 27
#: Lots of one task, at most.
LOTS = 1 << 12
#: The context before a text's first word, and the id of every word that isn't in the training texts.
START, UNKNOWN = -1, -2
LOT = "lot long, doc_id array<long>, train array<boolean>, sizes binary, tokens binary, words array<binary>, n array<long>, total array<long>"


def pack(x: np.ndarray) -> bytes:
    """*x* (64 bits a number) byte by byte in planes, compressed: high bytes and runs take next to nothing."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack(b: bytes, kind=np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _settle() -> None:
    """Lets Spark delete the shuffle files of finished steps, which it does when the driver's handles are collected.

    The listeners hold the last step's handles for a moment, hence the pauses.
    """
    for _ in range(3):
        time.sleep(0.7)
        gc.collect()
        SparkSession.active()._jvm.System.gc()


def tokens(text: str | None) -> list[bytes]:
    """The words of a whole text in UTF-8, A-Z lower-cased, and its end (empty)."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), b""]  # of bytes, both know ASCII only


def lots_of(documents: DataFrame, train: Column) -> DataFrame:
    """*documents* (doc_id, text) in lots of about LOT_CHARS characters, tokens as numbers of the lot's words; written once.

    Each lot has its words with their occurrences, in all its texts (total) and in those where
    *train* is true (n).  A lot is as large as a task's memory allows, whatever the tables' size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ids, flags, found, number, size, made = [], [], [], {}, 0, 0

        def lot() -> pa.RecordBatch:
            if made >= LOTS:
                raise ValueError(f"more than {LOTS} lots in a task: read smaller splits")
            flat, sizes = np.concatenate(found), np.array([len(x) for x in found])
            total = np.bincount(flat, minlength=len(number))
            by_count = np.argsort(-total, kind="stable")  # frequent words get small numbers
            rank = np.empty_like(by_count)
            rank[by_count] = np.arange(len(by_count))
            flat, words = rank.astype(np.int32)[flat], list(number)
            n = np.bincount(flat[np.repeat(np.array(flags, dtype=bool), sizes)], minlength=len(words))
            row = {"lot": [task * LOTS + made], "doc_id": pa.array([ids], pa.list_(pa.int64())), "train": [flags], "sizes": [pack(sizes)], "tokens": [pack(flat.astype(np.int64))]}
            return pa.RecordBatch.from_pydict(row | {"words": [[words[i] for i in by_count]], "n": [n.tolist()], "total": [total[by_count].tolist()]})

        for batch in batches:
            for i, text, flag in zip(batch["doc_id"].to_pylist(), batch["t"], batch["train"].to_pylist(), strict=True):
                words = tokens(text.as_py())
                ids.append(i)
                flags.append(bool(flag))
                found.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int32, count=len(words)))
                size += sum(map(len, words)) + len(words)
                if size >= LOT_CHARS:
                    yield lot()
                    ids, flags, found, number, size, made = [], [], [], {}, 0, made + 1
        if ids:
            yield lot()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t"), F.coalesce(train, F.lit(False)).alias("train"))
    return stash(rows.mapInArrow(run, LOT))


def word_ids(lots: DataFrame) -> DataFrame:
    """(lot, id, n, ways) of every lot: its words' ids, training occurrences, and to how many parts a context is dealt.

    A lot's different words are all that is shuffled; the most frequent word has a row a lot.
    """
    words = lots.select("lot", F.posexplode(F.arrays_zip("words", "n", "total")).alias("pos", "w")).select("lot", "pos", "w.*")
    same = Window.partitionBy("words")
    ways = F.ceil(F.sum("total").over(same) / HOT)
    keyed = words.select("lot", "pos", F.min(F.col("lot") * WORDS + F.col("pos")).over(same).alias("id"), F.sum("n").over(same).alias("n"), ways.alias("ways"))

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group["pos"].to_numpy())
        if len(order) > WORDS:
            raise ValueError(f"a lot with more than {WORDS} words")
        return pa.table({"lot": group["lot"][:1]} | {c: [pack(group[c].to_numpy()[order])] for c in ("id", "n", "ways")})

    return stash(keyed.groupBy("lot").applyInArrow(run, "lot long, id binary, n binary, ways binary"))


def discounts(counts: list[int]) -> np.ndarray:
    """What is left of a count r up to KATZ, as a share (1 at 0), by Good and Turing's estimate; *counts* are n_1, n_2, ... n_(KATZ+1).

    Katz's form, (r*/r - A) / (1 - A) with r* = (r+1) n_(r+1) / n_r and A = (KATZ+1) n_(KATZ+1) / n_1, where all shares
    are between 0 and 1.  Else (few texts, or copies that make some counts unlike their
    neighbours) r* comes from a power law fitted to the n_r, with an exponent of -1.1 at most.
    """
    n = dict(enumerate(counts, 1))
    if all(n[r] > 0 for r in n):
        a = (KATZ + 1) * n[KATZ + 1] / n[1]
        if a < 1:
            share = [((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a) for r in range(1, KATZ + 1)]
            if all(0 < s < 1 for s in share):
                return np.array([1.0, *share])
    known = [(math.log(r), math.log(n[r])) for r in n if n[r] > 0]
    slope = np.polyfit(*zip(*known, strict=True), 1)[0] if len(known) > 1 else -2.0
    return np.array([1.0, *((1 + 1 / r) ** (min(slope, -1.1) + 1) for r in range(1, KATZ + 1))])


def discounted(n: np.ndarray, share: np.ndarray) -> np.ndarray:
    return n * np.where(n <= KATZ, share[np.minimum(n, KATZ)], 1.0)


@dataclass
class Words:
    """The model of single words: *n* training tokens, *v* different ones, the discounts, what they leave, and the sum of all."""

    n: int
    v: int
    share: np.ndarray
    left: float
    whole: float

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the additive estimate that scores are compared with."""
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))

    def p(self, c: np.ndarray) -> np.ndarray:
        """Probability of a word with *c* training tokens; 0: of all unknown words together."""
        return np.where(c > 0, discounted(c, self.share), self.left) / self.whole

def learn_words(ids: DataFrame) -> Words:
    """Counts of counts of the words, each taken in the lot that names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(KATZ + 3, dtype=object)
        for batch in batches:
            for lot, i, n in zip(batch["lot"].to_pylist(), batch["id"].to_pylist(), batch["n"].to_pylist(), strict=True):
                own = unpack(n)[unpack(i) // WORDS == lot]
                sums[1 : KATZ + 2] += np.bincount(np.minimum(own, KATZ + 2), minlength=KATZ + 3)[1 : KATZ + 2]
                sums[0] += int((own > 0).sum())
                sums[-1] += int(own.sum())
        yield pa.RecordBatch.from_pydict({"at": list(range(len(sums))), "s": pa.array(sums.tolist(), pa.int64())})

    found = ids.select("lot", "id", "n").mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).collect()
    s = [0] * (KATZ + 3)
    for r in found:
        s[r["at"]] = r["s"]
    share = discounts(s[1 : KATZ + 2])
    left = sum((1 - share[r]) * r * s[r] for r in range(1, KATZ + 1))
    return Words(s[-1], s[0], share, left, s[-1]) if left > 0 else Words(s[-1], s[0], share, 1.0, s[-1] + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # 2**64 divided by the golden ratio
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


class Pairs:
    """The different pairs of neighbours in a lot, in a fixed order, and which one each token ends."""

    def __init__(self, row: dict, parts: int, start_ways: int):
        self.sizes, flat = unpack(row["sizes"]), unpack(row["tokens"]).astype(np.int32)
        ids, n, ways = (unpack(row[c]) for c in ("id", "c", "ways"))
        ids = np.append(np.where(n > 0, ids, UNKNOWN), START)
        self.flat_n, self.train = n[flat], np.repeat(np.array(row["train"], dtype=bool), self.sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        pair = np.concatenate(([0], flat[:-1].astype(np.int64)))
        pair[self.first] = len(n)
        pair *= len(n) + 1
        pair += flat
        pair, self.of_token = np.unique(pair, return_inverse=True)
        left, right = pair // (len(n) + 1), pair % (len(n) + 1)
        self.h, self.w, self.c = ids[left], ids[right], n[right]
        self.ways = np.append(ways, start_ways)[left]
        self.part = (_mix(self.h * 31 + (_mix(self.w) % self.ways.astype(np.uint64)).astype(np.int64)) % np.uint64(parts)).astype(np.int64)
        self.part[self.h == UNKNOWN] = -1  # after an unknown word there is nothing to look up
        self.order = np.argsort(self.part, kind="stable")
        self.cuts = np.searchsorted(self.part[self.order], np.arange(parts + 1))

    def in_part(self, part: int) -> np.ndarray:
        return self.order[self.cuts[part] : self.cuts[part + 1]]


def pair_table(rows: DataFrame, parts: int, start_ways: int) -> DataFrame:
    """A row for each part of the contexts: its pairs (h, w) with training occurrences n, and what each lot looks up.

    A lot sends its different pairs to their parts, once each.  A context with more than HOT
    occurrences is dealt to several parts by the word that follows.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = Pairs(row, parts, start_ways)
                n = np.bincount(p.of_token, weights=p.train, minlength=len(p.h)).astype(np.int64)
                for part in range(parts):
                    at = p.in_part(part)
                    if len(at):
                        columns = {"h": np.diff(p.h[at], prepend=0), "w": p.w[at], "n": n[at], "c": p.c[at], "ways": p.ways[at]}
                        yield pa.RecordBatch.from_pydict({"part": [part], "lot": [row["lot"]]} | {k: [pack(v)] for k, v in columns.items()})

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("lot")
        blocks = {k: [unpack(x) for x in group[k].to_pylist()] for k in ("h", "w", "n", "c", "ways")}
        sizes = [len(x) for x in blocks["w"]]
        h, (w, n, c, ways) = np.concatenate([x.cumsum() for x in blocks.pop("h")]), map(np.concatenate, blocks.values())
        order = np.lexsort((w, h))
        new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])))
        at = np.empty_like(order)
        at[order] = np.cumsum(new) - 1
        first, n = order[new], np.add.reduceat(n[order], np.flatnonzero(new))
        columns = {"h": np.diff(h[first], prepend=0), "w": w[first], "n": n, "c": c[first], "ways": ways[first], "at": at}
        of_counts = np.bincount(np.minimum(n, KATZ + 2), minlength=KATZ + 3)[1 : KATZ + 2]
        return pa.table({"part": group["part"][:1], "lots": [group["lot"].to_pylist()], "sizes": [sizes], "counts": [of_counts.tolist()]} | {k: [pack(v)] for k, v in columns.items()})

    blocks = rows.mapInArrow(send, "part long, lot long, h binary, w binary, n binary, c binary, ways binary")
    schema = "part long, lots array<long>, sizes array<long>, counts array<long>, h binary, w binary, n binary, c binary, ways binary, at binary"
    return stash(blocks.groupBy("part").applyInArrow(merge, schema))


class Contexts:
    """The contexts of a part: which pairs each has, and its sums over them (n, discounted n, probability of the words alone)."""

    def __init__(self, row: dict, words: Words, share: np.ndarray):
        self.h, self.w, self.n, self.c, self.ways = unpack(row["h"]).cumsum(), *(unpack(row[k]) for k in ("w", "n", "c", "ways"))
        self.first = np.flatnonzero(np.concatenate(([True], self.h[1:] != self.h[:-1])))
        self.which = np.cumsum(np.concatenate(([0], self.h[1:] != self.h[:-1])))
        self.kept, self.alone = discounted(self.n, share), words.p(self.c)
        sums = (np.add.reduceat(x, self.first) for x in (self.n.astype(float), self.kept, np.where(self.n > 0, self.alone, 0.0)))
        self.total, self.held, self.seen = sums

    def join(self, sums: list | None) -> None:
        """Take the sums over all parts for the contexts that were dealt to several; *sums*: (h, total, held, seen)."""
        if sums:
            h, *rest = (np.array(x) for x in zip(*((s["h"], s["total"], s["held"], s["seen"]) for s in sums), strict=True))
            at = np.searchsorted(self.h[self.first], h)
            self.total[at], self.held[at], self.seen[at] = rest

    def weights(self, unknown: float) -> tuple[np.ndarray, np.ndarray]:
        """(whole, weight) of each context.

        What the discounts leave goes to the words that don't follow in training, by their own
        probabilities, so that all words together have 1.  Where nothing is discounted one
        occurrence is added and left to them; a context without training tokens gives way at 1.
        """
        gone = self.total - self.held
        gone = np.where(gone > 1e-9 * self.total, gone, 1.0)
        whole = self.held + gone
        rest = np.maximum(1 - self.seen, unknown)  # the unknown words never follow
        return whole, np.where(self.total > 0, gone / whole / rest, 1.0)


def hot_sums(table: DataFrame, words: Words, share: np.ndarray) -> DataFrame:
    """(part, hot): for each part, the sums of its contexts that were dealt to several parts, over all of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Contexts(row, words, share)
                hot = np.flatnonzero(c.ways[c.first] > 1)
                yield pa.RecordBatch.from_pydict({"part": np.full(len(hot), row["part"]), "h": c.h[c.first[hot]], "total": c.total[hot], "held": c.held[hot], "seen": c.seen[hot]})

    some = stash(table.mapInArrow(run, "part long, h long, total double, held double, seen double"))
    sums = some.groupBy("h").agg(*(F.sum(x).alias(x) for x in ("total", "held", "seen")))
    return stash(some.select("part", "h").join(sums, "h").groupBy("part").agg(F.collect_list(F.struct("h", "total", "held", "seen")).alias("hot")))


def pair_model(table: DataFrame, words: Words) -> tuple[DataFrame, np.ndarray]:
    """The parts of :func:`pair_table` with the sums of dealt contexts (part, ..., hot), and the pairs' discounts."""
    counts = table.select(F.posexplode("counts").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()
    n = {r["r"]: r["n"] for r in counts}
    share = discounts([n.get(r, 0) for r in range(KATZ + 1)])
    return table.join(hot_sums(table, words, share), "part", "left"), share


def grams(model: DataFrame, words: Words, share: np.ndarray) -> DataFrame:
    """The model's pairs as rows (h, w, n, p, weight): p is P(w | h), weight what h gives the words that don't follow it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Contexts(row, words, share)
                c.join(row["hot"])
                whole, weight = c.weights(words.p(np.zeros(1, np.int64))[0])
                at = np.flatnonzero(c.n > 0)
                yield pa.RecordBatch.from_pydict({"h": c.h[at], "w": c.w[at], "n": c.n[at], "p": c.kept[at] / whole[c.which[at]], "weight": weight[c.which[at]]})

    return model.mapInArrow(run, "h long, w long, n long, p double, weight double")


def look_up(model: DataFrame, words: Words, share: np.ndarray) -> DataFrame:
    """(lot, part, values, at): what the pairs that each lot sent have in the table, in the order it sent them.

    A pair of training has its probability, which few values make up; any other has its context's
    weight, negative.  Hence the values once, and each pair's place among them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Contexts(row, words, share)
                c.join(row["hot"])
                whole, weight = c.weights(words.p(np.zeros(1, np.int64))[0])
                p = np.where(c.n > 0, c.kept / whole[c.which], -weight[c.which])
                values, end = p[unpack(row["at"])], np.cumsum(row["sizes"]).tolist()
                each = [np.unique(values[b - n : b], return_inverse=True) for n, b in zip(row["sizes"], end, strict=True)]
                yield pa.RecordBatch.from_pydict({"lot": row["lots"], "part": [row["part"]] * len(each), "values": [pack(v) for v, _ in each], "at": [pack(at) for _, at in each]})

    return model.mapInArrow(run, "lot long, part long, values binary, at binary")


def summed(rows: DataFrame, words: Words, parts: int, start_ways: int) -> DataFrame:
    """Scores of each document, from its lot's tokens and what came back for their pairs."""

    names = ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p = Pairs(row, parts, start_ways)
                value, alone = np.full(len(p.c), -1.0), words.p(p.c)  # after an unknown word each word has its own probability, at weight 1
                for part in row["found"] or []:
                    value[p.in_part(part["part"])] = unpack(part["values"], np.float64)[unpack(part["at"])]
                value = np.log10(np.where(value < 0, -value * alone, value))
                per = {"n_known": (p.flat_n > 0).astype(np.int64), "base_score": words.base(p.flat_n), "score": value[p.of_token]}
                sums = {k: np.add.reduceat(v, p.first) for k, v in per.items()}
                ids, n = pa.array(row["doc_id"], pa.int64()), np.full(len(p.sizes), words.n)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (row["train"], p.sizes, sums["n_known"], n, sums["base_score"], sums["score"]))], names)

    return rows.mapInArrow(run, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(documents: DataFrame, train: Column) -> DataFrame:
    """log10 probability of every whole text of *documents* (doc_id, text) by a model learned from those where *train* is true.

    Tokens are words between ASCII white space, A-Z lower-cased, and one end for each text (null:
    empty).  The model is Katz's: a pair's Good-Turing discounted share where training has the
    pair, else the context's weight times the word's own discounted share; words that training
    lacks are one unknown word.  For each context the probabilities sum to 1.  A null *train* is
    false.  Returns (doc_id, train, n_tokens, n_known, train_tokens, base_score, score), a row for each row.
    """
    lots = lots_of(documents, train)
    ids = word_ids(lots)
    words = learn_words(ids)
    sizes = lots.agg(F.sum(F.aggregate("total", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.size("doc_id"))).first()
    parts, start_ways = max(1, -(-(sizes[0] or 0) // PART_TOKENS)), max(1, -(-(sizes[1] or 0) // HOT))
    texts = stash(lots.select("lot", "doc_id", "train", "sizes", "tokens"))  # the words have done their part
    forget(lots)
    _settle()
    rows = texts.join(ids.withColumnRenamed("n", "c"), "lot")
    table = pair_table(rows, parts, start_ways)
    _settle()
    model, share = pair_model(table, words)
    found = stash(look_up(model, words, share))
    forget(table)
    _settle()
    each = found.groupBy("lot").agg(F.collect_list(F.struct("part", "values", "at")).alias("found"))
    out = stash(summed(rows.join(each, "lot", "left"), words, parts, start_ways))
    forget(texts, ids, found)
    return out
