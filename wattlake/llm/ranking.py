"""Ranked lexical search: every document scored for every item, equal bags of item terms scored once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import Shared, forget, lots, stash

#: Characters of items whose terms are looked up in one pass over the documents; more items take more passes.
BLOCK_CHARS = 4_000_000
#: Characters of texts, and (class, item) products, that a task works on at once.
LOT_CHARS, PRODUCTS = 4_000_000, 4_000_000
#: Bytes that are no part of a term become blanks, A-Z become a-z.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text, in UTF-8: runs of digits, letters A-Z (lower-cased) and whatever is not ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


class Items:
    """The terms of a block of items, and for each term the items that hold it, how often."""

    def __init__(self, texts: list[str | None]):
        counts = [Counter(terms(t)) for t in texts]
        self.n, self.vocabulary = len(texts), {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        held = sorted((self.vocabulary[t], i, q) for i, c in enumerate(counts) for t, q in c.items())
        term, self.item, self.times = np.array(held, dtype=np.int64).reshape(-1, 3).T
        self.count = np.bincount(term, minlength=len(self.vocabulary))
        self.start = np.concatenate(([0], np.cumsum(self.count)))[:-1]


def bags(documents: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, bag) of every document: how many terms it has, and which of the items' terms, how often.

    A bag is the ascending numbers of its terms, then how often each occurs, as 32-bit integers.
    """
    known = Shared(documents.sparkSession, items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known.get()
        for batch in batches:
            ids, at = batch["doc_id"], 0
            for lot in lots(batch["t"].to_pylist(), LOT_CHARS):
                n, held = [], []
                for text in lot:
                    found = terms(text)
                    n.append(len(found))
                    mine = Counter(map(vocabulary.get, found))
                    mine.pop(None, None)
                    held.append(np.array([*sorted(mine), *(mine[k] for k in sorted(mine))], dtype="<i4").tobytes())
                yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(at, len(lot)), "n": pa.array(n, pa.int64()), "bag": pa.array(held, pa.binary())})
                at += len(lot)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("t")).mapInArrow(run, "doc_id long, n long, bag binary")


def _apart(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the bag, term, occurrences) of all entries of *bags*."""
    sizes = np.array([len(b) // 8 for b in bags], dtype=np.int64)
    if not sizes.sum():
        return (np.zeros(0, dtype=np.int64),) * 3
    flat = np.frombuffer(b"".join(bags), dtype="<i4").astype(np.int64)
    which = np.repeat(np.arange(len(bags)), sizes)
    at = np.arange(len(which)) + np.repeat(np.cumsum(sizes) - sizes, sizes)  # where the entry's term stands, past the bags before it
    return which, flat[at], flat[at + sizes[which]]


def statistics(held: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms of all documents, documents that hold each of *n_terms* terms) of :func:`bags`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(n_terms + 2, dtype=np.int64)
        for batch in batches:
            n = batch["n"].to_numpy()
            sums[-2:] += (n > 0).sum(), n.sum()
            sums[:n_terms] += np.bincount(_apart(batch["bag"].to_pylist())[1], minlength=n_terms)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"at": at, "s": sums[at]})

    sums = np.zeros(n_terms + 2, dtype=np.int64)
    for r in held.select("n", "bag").mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).collect():
        sums[r["at"]] = r["s"]
    return int(sums[-2]), int(sums[-1]), sums[:n_terms]


def weights(n_documents: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) of each term, in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n_documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def classes(held: DataFrame, n_documents: int, all_terms: int, k: int) -> DataFrame:
    """(m, bag, members) of each class of documents with the same bag and the same m: the *k* least doc_ids of each.

    Classes are found by hash and told apart by the bags themselves.  More than *k* members of
    a class can't be among an item's *k* best, as equal scores go by doc_id (null last); a task passes on
    no more of a class, so copies by the million are no task's burden.
    """
    m = F.lit(75).cast("long") + F.expr(f"(25L * n * {n_documents}L) div {max(all_terms, 1)}L")
    rows = held.filter(F.octet_length("bag") > 0).select("doc_id", m.alias("m"), "bag").withColumn("h", F.xxhash64("m", "bag"))
    of_class = Window.partitionBy("h", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    few = rows.withColumn("r", F.row_number().over(of_class)).filter(F.col("r") <= k)
    return few.groupBy("h", "m", "bag").agg(F.array_sort(F.collect_list(F.struct("r", "doc_id"))).alias("members")).select("m", "bag", "members")


def _scores(m: np.ndarray, bags: list[bytes], items: Items, w: np.ndarray) -> np.ndarray:
    """Score of each class for each item, in 64-bit integers."""
    which, term, tf = _apart(bags)
    worth = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[which]))
    out = np.zeros(len(bags) * items.n, dtype=np.int64)
    n = items.count[term]
    cuts = np.searchsorted(np.cumsum(n), np.arange(PRODUCTS, n.sum() + PRODUCTS, PRODUCTS))
    for a, b in zip([0, *(cuts[:-1] + 1).tolist()], [*(cuts[:-1] + 1).tolist(), len(n)], strict=True):
        entry = np.repeat(np.arange(a, b), n[a:b])
        at = items.start[term[entry]] + np.arange(len(entry)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
        np.add.at(out, which[entry] * items.n + items.item[at], worth[entry] * items.times[at])
    return out.reshape(len(bags), items.n)


def best(found: DataFrame, items: Items, w: np.ndarray, k: int) -> DataFrame:
    """(item, score, doc_id) of the members of the *k* best of :func:`classes` for each item, by score and least member.

    A document among an item's *k* best is in one of these: each better class has a better document.
    """
    known = Shared(found.sparkSession, (items, w))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, w = known.get()
        kept_item, kept_score, kept_id, kept_members = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64), np.zeros(0, object)
        least = np.zeros(items.n, dtype=np.int64)  # an item's k-th score so far: what is below can't be kept
        for whole in batches:
            step = max(1, PRODUCTS // items.n)
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                members = np.empty(batch.num_rows, dtype=object)
                members[:] = [[x["doc_id"] for x in row] for row in batch["members"].to_pylist()]
                ids = np.empty(batch.num_rows, dtype=object)
                ids[:] = [x[0] for x in members]
                scores = _scores(batch["m"].to_numpy(), batch["bag"].to_pylist(), items, w)
                row, item = np.nonzero((scores > 0) & (scores >= least))
                kept_item, kept_score = np.concatenate((kept_item, item)), np.concatenate((kept_score, scores[row, item]))
                kept_id, kept_members = np.concatenate((kept_id, ids[row])), np.concatenate((kept_members, members[row]))
                number = np.array([x if x is not None else np.iinfo(np.int64).max for x in kept_id], dtype=np.int64)
                order = np.lexsort((number, [x is None for x in kept_id], -kept_score, kept_item))
                first = np.searchsorted(kept_item[order], np.arange(items.n))
                place = np.arange(len(order)) - first[kept_item[order]]
                order, place = order[place < k], place[place < k]
                kept_item, kept_score, kept_id, kept_members = kept_item[order], kept_score[order], kept_id[order], kept_members[order]
                last = place == k - 1
                least[kept_item[last]] = kept_score[last]
        sizes = [len(x) for x in kept_members]
        yield pa.RecordBatch.from_pydict({
            "item": np.repeat(kept_item, sizes), "score": np.repeat(kept_score, sizes), "doc_id": pa.array([i for x in kept_members for i in x], pa.int64()),
        })

    return found.mapInArrow(run, "item long, score long, doc_id long")


def search(documents: DataFrame, queries: DataFrame, k: int = 20, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the *k* best of *documents* (doc_id, text) for each of *queries* (item_id, text).

    Each row of either table is a document or an item of its own, whatever ids repeat; null
    texts have no terms, and an item that no document has a term of gets no row.  Equal scores
    go by ascending doc_id, null last.  Documents' terms are looked up among the items' in one pass
    for each *block_chars* characters of items, of which tasks hold the terms; more items take more passes.
    """
    spark = documents.sparkSession
    asked = stash(queries.groupBy("item_id", "text").agg(F.count("*").alias("copies")))
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_chars))
    out, kept = [], [asked]
    for block in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        items = Items([r["text"] for r in mine])
        if not items.vocabulary:
            continue
        held = stash(bags(documents, items))
        n_documents, all_terms, df = statistics(held, len(items.vocabulary))
        found = best(classes(held, n_documents, all_terms, k), items, weights(n_documents, df), k)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, r["item_id"], r["copies"]) for i, r in enumerate(mine)], f"item long, item_id {queries.schema['item_id'].dataType.simpleString()}, copies long")
        each = ranked.join(names, "item").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        out.append(stash(each.select("item_id", "rank", "doc_id", "score")))
        kept.append(held)
    forget(*kept)
    if not out:
        return spark.createDataFrame([], f"item_id {queries.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0]
