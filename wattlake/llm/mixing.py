"""Mixing sources to target weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import forget, stash

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: The mix has this share of all words; no source, and no document, gives more than CAP times its own.
SHARE, CAP = 1.5, 2.0
#: Newton ends when every source's expected words are this near its target, relatively.
NEAR, MOST_ROUNDS = 1e-9, 60
#: Documents of a source that are rounded together; rows alike in id and text of which so many stay together.
BUCKET, ALIKE = 512, 64


def sized(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, text_hash): size is the number of words, runs of other than ASCII white space; null text has 0."""
    words = F.size(F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.when(F.col(text_col).isNull(), 0).otherwise(words).cast("long").alias("size"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place``: 0, 1, ... in order of name by code point, null last.

    The sort is by ranges; only one row for each of its partitions meets in one task.
    """
    ordered = stash(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_m", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("_p").agg((F.max("_i") + 1).alias("_n")).withColumn("_o", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return ordered.join(offsets, "_p").select("source", "source_size", (F.col("_i") + F.col("_o")).alias("place"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target): the words that the mix should take of each source.

    Sources in order of name (code points, null last) have *weights* in turn and share
    ``share`` x all words; a target stops at cap x its source's words, and the excess is shared
    again by weight until none is above.
    """
    source = stash(_ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))))
    w = F.get(F.array(*map(F.lit, weights)), F.pmod("place", F.lit(len(weights))).cast("int"))
    source = source.select("source", "source_size", w.alias("w"), (F.col("source_size") * cap).alias("most"))
    rate, stopped = 0.0, F.lit(False)
    count = -1
    while True:  # each round stops one more source at least; two numbers come to the driver
        r = source.agg(F.sum("source_size").alias("all"), F.sum(F.when(stopped, F.col("most")).otherwise(0.0)).alias("full"), F.sum(F.when(stopped, 0.0).otherwise(F.col("w"))).alias("open"), F.count_if(stopped).alias("n")).first()
        if not r["all"] or not r["open"] or r["n"] == count:
            break
        rate, count = max(rate, (share * r["all"] - r["full"]) / r["open"]), r["n"]
        stopped = F.col("w") * rate >= F.col("most")
    return source.select("source", "source_size", F.least(F.col("w") * rate, "most").alias("target"))


def rates(histogram: DataFrame, target: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, tilt, scale, full): what gives each document of a source its rate; see :func:`document_rate`.

    The rates are nearest to 1 in entropy (that of cap and cap - rate, so that they stay between
    0 and cap) among those whose words sum to the source's target.  In the dual, which is convex,
    that is one multiplier a source: rate = cap / (1 + (cap - 1) exp(-tilt x size / scale)).
    Each Newton round sums words and slopes over *histogram* (source, size, n), one row for each
    size that occurs, in one distributed aggregate; a step that leaves the bracket is halved.
    A source whose target is its cap has the rate cap (``full``).  Newton that hasn't come NEAR
    after MOST_ROUNDS is an error.
    """
    key = F.struct(F.col("source").isNull().alias("k"), F.coalesce("source", F.lit("")).alias("s"))
    base = histogram.withColumn("_s", key)
    scale = base.groupBy("_s").agg((F.sum(F.col("size") * F.col("size") * F.col("n")) / F.greatest(F.sum(F.col("size") * F.col("n")), F.lit(1))).alias("scale"))
    now = target.withColumn("_s", key).join(scale, "_s", "left").select("_s", "source", "source_size", "target", F.greatest(F.coalesce("scale", F.lit(1.0)), F.lit(1.0)).alias("scale"))
    full = F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)
    now = now.withColumn("full", full).withColumn("tilt", F.lit(0.0)).withColumn("low", F.lit(-1e6)).withColumn("high", F.lit(1e6)).withColumn("off", F.lit(1.0))
    kept = now = stash(now)
    for _ in range(MOST_ROUNDS):
        rate = cap / (1 + (cap - 1) * F.exp(-F.col("tilt") * F.col("size") / F.col("scale")))
        slope = rate * (1 - rate / cap) * F.col("size") / F.col("scale")
        sums = base.join(now.filter(~F.col("full")).select("_s", "tilt", "scale"), "_s").groupBy("_s").agg(F.sum(rate * F.col("size") * F.col("n")).alias("got"), F.sum(slope * F.col("size") * F.col("n")).alias("by"))
        miss = F.col("target") - F.col("got")
        low, high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low")), F.when(miss < 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") + F.try_divide(miss, "by")
        half = F.when((low > -1e6) & (high < 1e6), (low + high) / 2).otherwise(F.col("tilt") + F.signum(miss) * F.greatest(F.abs("tilt"), F.lit(1.0)))
        moved = F.when(F.col("got").isNull(), F.col("tilt")).when((step > low) & (step < high) & (F.abs(step - F.col("tilt")) < 50), step).otherwise(half)
        now = now.join(sums, "_s", "left").select("_s", "source", "source_size", "target", "scale", "full", moved.alias("tilt"), low.alias("low"), high.alias("high"), F.coalesce(F.abs(miss) / F.greatest("target", F.lit(1.0)), F.lit(0.0)).alias("off"))
        before, now = kept, stash(now)
        forget(before)
        kept = now
        if (now.agg(F.max("off")).first()[0] or 0.0) <= NEAR:
            break
    else:
        raise RuntimeError(f"a source's words are still more than {NEAR} off its target after {MOST_ROUNDS} rounds")
    return now.select("_s", "source_size", "target", F.round("tilt", 9).alias("tilt"), "scale", "full")


def _apart(rows: DataFrame) -> DataFrame:
    """*rows* of :func:`sized` with the hash ``_h`` that deals them out: ALIKE rows that are alike have the same, the next another."""
    columns = ["doc_id", "source", "size", "text_hash"]
    lots = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_j", F.explode(F.expr(f"sequence(0L, (_n - 1) div {ALIKE})")))
    place = F.when(F.col("_j") == 0, F.xxhash64("doc_id", "size", "text_hash")).otherwise(F.xxhash64("doc_id", "size", "text_hash", "_j"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ALIKE).cast("long"), F.col("_n") - F.col("_j") * ALIKE)))
    return lots.select(*columns, place.alias("_h"), each.alias("_e")).drop("_e")


def mix(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(doc_id, text_hash, source, size, source_size, target, rate, copies, taken) for every row.

    ``rate`` is the balanced rate (0 to cap), ``copies`` what it is rounded to, ``taken`` the
    words that the mix takes (copies x size).  Rounding is by running sums: the documents of a
    source are dealt by hash to buckets of about BUCKET rows; within one, in order of size, a
    document gets the whole copies that the running sum of rates passes, and what the bucket
    then lacks or has too much is made up by its smallest documents.  No step needs a source's
    rows in one task, nor those alike in id and text.  Null and empty texts have size 0 and take 0; a null source is a source of
    its own, the last; rows that repeat an id count each for itself.  No random numbers: reruns
    agree.
    """
    rows = stash(sized(documents))
    histogram = stash(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    solved = rates(histogram, targets(histogram.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, cap), cap)
    counts = histogram.groupBy("source").agg(F.sum("n").alias("docs"))
    key = F.struct(F.col("source").isNull().alias("k"), F.coalesce("source", F.lit("")).alias("s"))
    solved = solved.join(counts.select(key.alias("_s"), "docs"), "_s")
    joined = _apart(rows).withColumn("_s", key).join(solved, "_s")
    rate = F.when(F.col("full"), F.lit(cap)).otherwise(cap / (1 + (cap - 1) * F.exp(-F.col("tilt") * F.col("size") / F.col("scale"))))
    dealt = joined.withColumn("rate", rate).withColumn("_b", F.pmod(F.shiftright("_h", 20), F.ceil(F.col("docs") / BUCKET)))
    group = Window.partitionBy("_s", "_b")
    order = group.orderBy(F.desc("size"), "_h", "doc_id")
    # rates in whole billionths, so that sums are exact in any order
    unit = 1_000_000_000
    running = F.sum("_u").over(order.rowsBetween(Window.unboundedPreceding, 0))
    passed = lambda sum_: F.floor((sum_ + unit // 2) / F.lit(unit))
    first = dealt.withColumn("_u", F.round(F.col("rate") * unit).cast("long")).withColumn("_w", running)
    first = first.withColumn("_copies", F.least(F.greatest(passed(F.col("_w")) - passed(F.col("_w") - F.col("_u")), F.lit(0)), F.lit(int(cap))))
    first = first.withColumn("_lack", F.round(F.sum(F.col("_u") * F.col("size")).over(group) / unit) - F.sum(F.col("_copies") * F.col("size")).over(group))
    # one copy more, or one less, of the smallest documents that can have it, as long as it brings the bucket nearer
    free = F.when(F.col("size") == 0, False).when(F.col("_lack") > 0, F.col("_copies") < int(cap)).when(F.col("_lack") < 0, F.col("_copies") > 0).otherwise(False)
    small = group.orderBy("size", "_h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    mended = first.withColumn("_free", free).withColumn("_p", F.sum(F.when(F.col("_free"), F.col("size")).otherwise(0)).over(small))
    change = F.when(F.col("_free") & (F.col("_p") - F.col("size") / 2 <= F.abs("_lack")), F.signum("_lack")).otherwise(0.0)
    copies = (F.col("_copies") + change).cast("long")
    return mended.select("doc_id", "text_hash", "source", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def repeated(documents: DataFrame, **kwargs) -> DataFrame:
    """*documents* with each row as many times as the mix copies it (rows with size 0 stay out).

    Rows alike in id and text are taken each time by the mean of the copies of all of them.
    """
    copies = mix(documents, **kwargs).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_t")).agg(F.round(F.avg("copies")).cast("int").alias("_copies"))
    rows = documents.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"), F.struct("*").alias("_row"))
    joined = rows.join(copies.filter("_copies > 0"), rows["_id"].eqNullSafe(copies["_id"]) & (rows["_t"] == copies["_t"]))
    return joined.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_copies")))).select("_row.*")
