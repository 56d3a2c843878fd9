"""What the operators of this subpackage share: table reading, stashing, bounded samples."""

from __future__ import annotations

import itertools
import pickle
import sys
import types
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import forget, stash  # noqa: F401  (operators take them from here)

#: Classes (labels, languages) that a model can be fitted on.
MOST_CLASSES = 200
#: Steps of the hash by which rows are chosen.
STEPS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, divisor: int):
    """crc32 of the id as text, modulo *divisor*; a null id belongs to no fold (null)."""
    return F.crc32(F.col(column).cast("string")) % F.lit(divisor)


def thinned(rows: DataFrame, sizes: DataFrame, per_class: int) -> DataFrame:
    """*rows* (id, class, ...) of which each class keeps about twice *per_class* ids, chosen by a hash of the id.

    *sizes* (class, n) are the ids of each class; more than MOST_CLASSES classes are an error.
    """
    known = sizes.limit(MOST_CLASSES + 1).collect()
    if len(known) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    keep = F.lit(False)
    for r in known:
        share = min(STEPS, int(STEPS * 2 * per_class / r["n"]) + 1)
        keep = keep | ((F.col("class") == F.lit(r["class"])) & (F.pmod(F.xxhash64("id"), F.lit(STEPS)) < share))
    return rows.filter(keep)


def class_sample(rows: DataFrame, per_class: int, most_chars: int) -> list[tuple[str, object]]:
    """(text, class) of *rows* (id, text, class): at most *per_class* whole texts of each class, chosen by a hash of the id.

    Of each class those of the least hashes are taken, as long as they have not more than
    *most_chars* characters together (one text it always has); so what comes to the driver is
    bounded, whatever ids repeat, and no text is cut.  The same rows whatever their order.
    *rows* are :func:`thinned` first; they are written once, then each class is a top-n of them,
    of which a task passes on *per_class* rows at most.
    """
    kept = stash(rows.select("id", "text", "class"))
    keys = {"_p": F.pmod(F.xxhash64("id"), F.lit(STEPS)), "_h": F.xxhash64("id"), "_t": F.xxhash64("text")}
    classes = sorted(r[0] for r in kept.select("class").distinct().collect())

    def least(n: dict, *columns) -> list:
        parts = [kept.filter(F.col("class") == F.lit(c)).withColumns(keys).orderBy(*keys, "text").limit(n[c]).select("class", *columns) for c in classes]
        return reduce(DataFrame.unionByName, parts).collect() if parts else []

    sizes: dict = {c: [] for c in classes}
    for r in sorted(least(dict.fromkeys(classes, per_class), *keys, F.length("text").alias("n")), key=lambda r: tuple(r[k] for k in keys)):
        sizes[r["class"]].append(r["n"])
    take = {c: max(1, sum(so_far <= most_chars for so_far in itertools.accumulate(n))) for c, n in sizes.items()}
    found = sorted((r["text"], r["class"]) for r in least(take, "text"))
    forget(kept)
    return found


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int, most_chars: int) -> list[tuple[str, int]]:
    """Rows (text, label) to fit a classifier on, never from the held-out fold (crc32 mod 3 = 1); see :func:`class_sample`.

    An id with several labels has the least.  Null texts and labels are left out.
    """
    known = labels.filter(F.col(label).isin(0, 1) & (fold("doc_id", 3) != 1)).groupBy(F.col("doc_id").alias("id")).agg(F.min(label).alias("class"))
    few = thinned(known, known.groupBy("class").agg(F.count("*").alias("n")), per_class)  # distinct ids, about four times per_class
    texts = documents.filter(F.col("text").isNotNull()).select(F.col("doc_id").alias("id"), "text")
    return class_sample(texts.join(F.broadcast(few), "id"), per_class, most_chars)


def lots(texts: list[str | None], most: int) -> Iterator[list[str | None]]:
    """*texts* in lots of about *most* characters; a longer text is a lot of its own."""
    lot, size = [], 0
    for t in texts:
        lot.append(t)
        size += len(t or "")
        if size >= most:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def of_worker(kind: str, key, make):
    """What ``make()`` gave for *key* in this Python worker process, where that was the last thing asked for.

    Spark runs many tasks in one worker; what a task has learned (caches of fixed size) or
    unpickled serves the next of its stage, and goes when another stage needs something else.
    Results never depend on it.
    """
    kept = sys.modules.setdefault("_wattlake_worker", types.ModuleType("_wattlake_worker")).__dict__.setdefault("kept", {})
    if kept.get(kind, (None, None))[0] != key:
        kept.clear()
        kept[kind] = (key, make())
    return kept[kind][1]


class Shared:
    """A fitted model that tasks read: broadcast as pickled bytes, unpickled once for each worker.

    Models have a size fixed by their parameters, whatever the size of the tables.
    """

    def __init__(self, spark: SparkSession, model):
        self.sent, self.key = spark.sparkContext.broadcast(cloudpickle.dumps(model)), uuid.uuid4().hex

    def get(self, prepare=lambda model: model):
        return of_worker(type(self).__name__ + prepare.__name__, self.key, lambda: prepare(pickle.loads(self.sent.value)))
