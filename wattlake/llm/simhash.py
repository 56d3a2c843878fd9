"""SimHash near-dedup: tiled exact comparison of fingerprints with xor and bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import stash
from wattlake.llm.graph import MinForest, components

#: Tiles hold a sixteenth of the fingerprints, within these bounds.
LEAST_TILE, MOST_TILE = 2048, 131_072
#: Rows of a tile that are compared, or skipped, at once.
BLOCK = 256
#: Shingles of a block in which texts are compared by their shingles; a larger group of candidates has several blocks.
SHINGLES = 1_000_000
SEED = 42


def _spans(text: str | None, words: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The words of *text* with a space between, and where in that each shingle begins and ends."""
    # bytes.lower and bytes.split know just A-Z and \x20\x09-\x0D
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return b"", []
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    return b" ".join(parts), list(zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The different shingles of *text*, as XXH64 in ascending order."""
    joined, spans = _spans(text, words)
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64))


def _in_lane(hashes: np.ndarray, lane: int) -> np.ndarray:
    """*hashes* for *lane*: themselves in lane 0; in others mixed anew with the lane's number, so that lanes are independent."""
    if not lane:
        return hashes
    x = hashes ^ np.uint64(lane * 0x9E3779B97F4A7C15 % 2**64)
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def fingerprint(text: str | None, words: int = 3, lanes: int = 1, settle: bool = False, once: bool = False) -> list[int]:
    """*lanes* signed 64-bit lanes of the SimHash of *text*; see :func:`fingerprints`."""
    joined, spans = _spans(text, words)
    if not spans:
        return [0] * lanes
    out = []
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    if once:
        own = np.unique(own)
    for lane in range(lanes):
        hashes = _in_lane(own, lane)
        set_in = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 65_536):
            set_in += np.unpackbits(hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        bits = 2 * set_in > len(hashes)
        if settle:
            least = np.unpackbits(hashes.min(keepdims=True).astype(">u8").view(np.uint8)).astype(bool)
            bits = np.where(2 * set_in == len(hashes), least, bits)
        out.append(int(np.packbits(bits).view(">i8")[0]))
    return out


def fingerprints(documents: DataFrame, words: int = 3, lanes: int = 1, settle: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, f0, f1, ...): the SimHash of every whole text, 64 bits a lane.

    Text is lower-cased in A-Z, split on ASCII white space, and read as shingles of *words*
    words, repeats included (a shorter text is one shingle; null, empty and blank texts have
    the zero fingerprint).  A bit is set if over half of the shingles' XXH64 have it set; further
    lanes mix those hashes anew.  A tie leaves it unset, or with *settle* takes the bit of the least
    hash, so that texts of two or four shingles aren't alike by their many ties.  Rows keep
    their (maybe null or repeated) id.
    """
    names = [f"f{i}" for i in range(lanes)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, words, lanes, settle) for t in batch["t"]], dtype=np.int64).reshape(-1, lanes)
            yield pd.DataFrame({"doc_id": batch["doc_id"]} | {n: found[:, i] for i, n in enumerate(names)})

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return rows.mapInPandas(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def _tiles(histogram: dict[int, int], tile: int, radius: int) -> dict[int, tuple[int, int, int, int]]:
    """For each population count: its first tile, how many tiles it has, first and last tile in reach.

    Tiles are numbered in order of population count.  A count with more rows than *tile* is dealt
    to several tiles by hash; rare counts share one.  In reach is what comes within *radius*.
    """
    groups: list[dict] = []
    for count in sorted(histogram):
        n = -(-histogram[count] // tile)
        if n == 1 and groups and groups[-1]["n"] == 1 and groups[-1]["rows"] + histogram[count] <= tile:
            groups[-1] |= {"high": count, "rows": groups[-1]["rows"] + histogram[count]}
        else:
            at = groups[-1]["at"] + groups[-1]["n"] if groups else 0
            groups.append({"low": count, "high": count, "at": at, "n": n, "rows": histogram[count]})
    out = {}
    for g in groups:
        near = [x for x in groups if g["low"] - x["high"] <= radius and x["low"] - g["high"] <= radius]
        for count in range(g["low"], g["high"] + 1):
            out[count] = (g["at"], g["n"], near[0]["at"], near[-1]["at"] + near[-1]["n"] - 1)
    return out


def _quarters(lanes: np.ndarray) -> np.ndarray:
    """Population counts of the 16-bit parts of each fingerprint."""
    return np.bitwise_count(np.ascontiguousarray(lanes).view(np.uint16).reshape(len(lanes), -1)).astype(np.int16)


class _Blocks:
    """Fingerprints in order of their parts' population counts, with the bounds of each block."""

    def __init__(self, lanes: np.ndarray, place: np.ndarray, compared: int):
        q = _quarters(lanes[:, :compared])
        order = np.lexsort(q.T[::-1])
        self.lanes, self.place, q = lanes[order], place[order], q[order]
        at = np.arange(0, len(q), BLOCK)
        self.low, self.high = np.minimum.reduceat(q, at, axis=0), np.maximum.reduceat(q, at, axis=0)


def _near_beside(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray, lanes: int, beside: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (x, y) those that differ in at most *beside* bits of the lanes after the first *lanes* too."""
    near = np.bitwise_count(left[x, lanes:] ^ right[y, lanes:]).sum(1, dtype=np.int64) <= beside
    return x[near], y[near]


def _link_near(left: _Blocks, right: _Blocks, radius: int, forest: MinForest, lanes: int, beside: int | None) -> None:
    """Link what differs in at most *radius* bits of *lanes* (and in *beside* of the others); block pairs whose counts differ by more are skipped."""
    same = left is right
    for i in range(len(left.low)):
        gap = np.maximum(left.low[i] - right.high, right.low - left.high[i]).clip(0).sum(1)
        near = np.flatnonzero(gap <= radius)
        if same:
            near = near[near >= i]
        mine, places = left.lanes[i * BLOCK : (i + 1) * BLOCK], left.place[i * BLOCK : (i + 1) * BLOCK]
        for at in range(0, len(near), 16):
            rows = (near[at : at + 16, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows = rows[rows < len(right.lanes)]
            theirs = right.lanes[rows]
            bits = np.bitwise_count(mine[:, 0, None] ^ theirs[None, :, 0])
            for lane in range(1, lanes):
                bits = bits + np.bitwise_count(mine[:, lane, None] ^ theirs[None, :, lane])
            x, y = np.nonzero(bits <= radius)
            if beside is not None:
                x, y = _near_beside(mine, theirs, x, y, lanes, beside)
            if len(x):
                forest.link(places[x], right.place[rows[y]])


def near_components(prints: DataFrame, radius: int = 3, lanes: int | None = None, beside: int | None = None) -> DataFrame:
    """(doc_id, f0.., component_id) for the rows of :func:`fingerprints`.

    Fingerprints that differ in at most *radius* bits are linked; with *beside* only the first
    *lanes* count there, and the others must differ in at most *beside* bits; component_id is the smallest
    doc_id that links lead to, the row's own included (null where no row of the fingerprint has
    an id).  Every pair of distinct fingerprints is compared, except where population counts
    alone show that it differs in more bits.  Copies are compared once, as one fingerprint.  A
    task sends on one link for each fingerprint it has linked, so a group of n near copies
    costs at most n rows a tile pair, and no link between different fingerprints is lost.
    """
    names = [c for c in prints.columns if c[0] == "f"]
    compared = len(names) if lanes is None else lanes
    prints = stash(prints)
    distinct = prints.groupBy(*names).agg(F.min("doc_id").alias("rep")).filter("rep is not null")
    counted = distinct.withColumn("bits", sum((F.bit_count(n) for n in names[:compared]), F.lit(0)).cast("int"))
    # one row for each population count: 65 a lane at most
    histogram = {r[0]: r[1] for r in counted.groupBy("bits").count().collect()}
    tiles = _tiles(histogram, max(LEAST_TILE, min(MOST_TILE, sum(histogram.values()) // 16)), radius)
    if not tiles:
        return prints.withColumn("component_id", F.lit(None).cast("long"))
    layout = F.array(*[F.array(*map(F.lit, tiles.get(count, (0, 1, 0, 0)))) for count in range(64 * compared + 1)])
    own = F.get(layout, F.col("bits"))
    placed = counted.withColumn("_l", own).select("rep", *names, "_l", (F.col("_l")[0] + F.pmod(F.xxhash64("rep"), F.col("_l")[1])).cast("int").alias("_t"))
    dealt = placed.select("rep", *names, "_t", F.explode(F.sequence(F.col("_l")[2], F.col("_l")[3])).alias("_o"))
    dealt = dealt.select("rep", *names, F.least("_t", "_o").alias("x"), F.greatest("_t", "_o").alias("y"), (F.col("_t") <= F.col("_o")).alias("home"), (F.col("_t") >= F.col("_o")).alias("guest"))

    def compare(pair: pd.DataFrame) -> pd.DataFrame:
        rank = np.argsort(np.argsort(pair["rep"].to_numpy(), kind="stable"), kind="stable")
        bits = pair[names].to_numpy(dtype=np.int64).view(np.uint64)
        home, guest = pair["home"].to_numpy(dtype=bool), pair["guest"].to_numpy(dtype=bool)
        forest = MinForest(len(pair))
        if home.all():
            one = _Blocks(bits, rank, compared)
            _link_near(one, one, radius, forest, compared, beside)
        elif home.any() and guest.any():
            _link_near(_Blocks(bits[home], rank[home], compared), _Blocks(bits[guest], rank[guest], compared), radius, forest, compared, beside)
        by_rank = np.sort(pair["rep"].to_numpy(), kind="stable")
        a, b = forest.links()
        return pd.DataFrame({"a": by_rank[a], "b": by_rank[b]})

    found = components(dealt.groupBy("x", "y").applyInPandas(compare, "a long, b long"))
    classes = distinct.join(found, F.col("rep") == F.col("node"), "left").select(*names, F.coalesce("component_id", "rep").alias("component_id"))
    return prints.join(classes, names, "left").select("doc_id", *names, "component_id")


def hex_fingerprint(names: list[str]):
    """The lanes as lowercase hex digits, 16 a lane."""
    return F.concat(*[F.lpad(F.lower(F.hex(n)), 16, "0") for n in names])


def _alike(group: pd.DataFrame, names: list[str], radius: int, least: float, compared: int, beside: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (nodes, nodes) to the smallest of each set that the texts of *group* form.

    Every pair within *radius* is checked by its shingles unless links lead from one to the other
    already; so the sets are those that checking all of them gives.
    """
    group = group.sort_values("node")
    nodes, sets = group["node"].to_numpy(), group["shingles"].to_list()
    lanes, size = group[names].to_numpy(dtype=np.int64).view(np.uint64), group["n"].to_numpy()
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for at in range(0, len(nodes), BLOCK):
        bits = sum(np.bitwise_count(lanes[at : at + BLOCK, lane, None] ^ lanes[None, at:, lane]).astype(np.int16) for lane in range(compared))
        low, high = np.minimum(size[at : at + BLOCK, None], size[None, at:]), np.maximum(size[at : at + BLOCK, None], size[None, at:])
        x, y = np.nonzero((bits <= radius) & (low >= least * high - 1e-9))
        x, y = _near_beside(lanes[at : at + BLOCK], lanes[at:], x, y, compared, beside)
        for i, j in zip((x[x < y] + at).tolist(), (y[x < y] + at).tolist(), strict=True):
            a, b = find(i), find(j)
            if a == b:
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if both >= least * (size[i] + size[j] - both) - 1e-9:
                root[max(a, b)] = min(a, b)
    up = np.array([find(i) for i in range(len(nodes))], dtype=np.int64)
    inner = np.flatnonzero(up != np.arange(len(nodes)))
    return nodes[inner], nodes[up[inner]]


def _checked(members: DataFrame, names: list[str], words: int, radius: int, least: float, compared: int, beside: int) -> DataFrame:
    """(a, b): links of the texts of *members* (component_id, node, f0.., text), those candidates that share enough shingles.

    Candidates of a component meet in blocks of about SHINGLES shingles, however large it is or
    they are; small components share a block.  Texts of a large one are dealt by size, for a
    text can be like those only that have at least *least* times its shingles.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, words) for t in batch["text"]]
            yield batch.drop(columns="text").assign(n=[len(x) for x in found], shingles=[x.view(np.int64) for x in found])

    lanes = "".join(f"{n} long, " for n in names)
    rows = members.select("component_id", "node", *names, "text").mapInPandas(run, f"component_id long, node long, {lanes}n long, shingles array<long>")
    # a step of size is a little more than 1 / least, so partners are a step apart at most
    rows = stash(rows.filter("n > 0").withColumn("k", F.floor(F.log("n") / F.log(F.lit(1.01 / least))).cast("int")))
    total = rows.groupBy("component_id").agg(F.sum("n").alias("all")).select("component_id", (F.col("all") > SHINGLES).alias("large"), "all")
    small = F.lit(max(1, (rows.agg(F.sum("n")).first()[0] or 0) // SHINGLES))
    rows = rows.join(total.select(F.col("component_id").bitwiseXOR(F.lit(0)).alias("component_id"), "large"), "component_id")
    few = rows.filter("not large").select("*", F.lit(None).cast("long").alias("c"), F.pmod(F.xxhash64("component_id"), small).cast("int").alias("k1"), *[F.lit(0).alias(x) for x in ("b1", "k2", "b2")])
    steps = rows.filter("large").groupBy("component_id", "k").agg(F.ceil(F.sum("n") / F.lit(SHINGLES)).cast("int").alias("b"))
    # a large component has at most some hundred steps of size, whatever its texts
    layout = steps.groupBy("component_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "b"))).alias("blocks"))
    many = rows.filter("large").join(layout.select(F.col("component_id").bitwiseXOR(F.lit(0)).alias("component_id"), "blocks"), "component_id")
    many = many.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")[F.col("k")]).cast("int"))
    to = lambda k: F.when(F.col("blocks")[k].isNotNull(), F.sequence(F.lit(0), F.col("blocks")[k] - 1)).otherwise(F.array().cast("array<int>"))
    spot = lambda k1, b1, k2, b2: F.struct(k1.alias("k1"), b1.alias("b1"), k2.alias("k2"), b2.alias("b2"))
    k, own = F.col("k"), F.col("own")
    here = F.transform(to(k), lambda j: spot(k, F.least(own, j), k, F.greatest(own, j)))
    above = F.transform(to(k + 1), lambda j: spot(k, own, k + 1, j))
    below = F.transform(to(k - 1), lambda j: spot(k - 1, j, k, own))
    many = many.select("*", F.col("component_id").alias("c"), F.explode(F.concat(here, above, below)).alias("_at")).select("*", "_at.*")
    kept = ["component_id", "node", *names, "n", "shingles", "c", "k1", "b1", "k2", "b2"]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        links = [_alike(g, names, radius, least, compared, beside) for _, g in group.groupby("component_id", sort=False)]
        return pd.DataFrame({"a": np.concatenate([a for a, _ in links]), "b": np.concatenate([b for _, b in links])})

    return few.select(kept).unionByName(many.select(kept)).groupBy("c", "k1", "b1", "k2", "b2").applyInPandas(compare, "a long, b long")


def keep_one_of_each(documents: DataFrame, words: int = 5, lanes: int = 2, radius: int = 36, least: float = 0.8, more: int = 2, beside: int = 40) -> DataFrame:
    """The rows of *documents* but for near copies: of each group the one with the smallest doc_id stays.

    Texts are near copies if their sets of shingles of *words* words have a similarity (Jaccard)
    of *least* or more; a group is what such links lead to.  SimHashes of the sets only choose
    which pairs are checked: by default those that differ in 36 of 128 bits or less and in 40 of
    *more* (2) further lanes' 128, where at a similarity of 0.8 the means are 19 and the deviations
    4.  Unrelated texts differ in about 64 of each and come that near with a probability below
    1e-11, so that they don't chain into one group where there are very many. Blank texts are copies
    of each other.  Rows go one by one: of rows with one id, those stay whose text has no copy
    before it, and of rows with the same id and text one.  Rows with a null id are kept.
    """
    names = [f"f{i}" for i in range(lanes + more)]
    key = F.sha2(F.coalesce("text", F.lit("")), 256)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.array([fingerprint(t, words, len(names), settle=True, once=True) for t in batch["t"]], dtype=np.int64).reshape(-1, len(names))
            blank = [not (t or "").encode("utf-8", "surrogatepass").split() for t in batch["t"]]
            yield batch.drop(columns="t").assign(blank=blank).assign(**{n: found[:, i] for i, n in enumerate(names)})

    rows = documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("t"), key.alias("sha"))
    prints = stash(rows.mapInPandas(run, "id long, sha string, blank boolean, " + ", ".join(f"{n} long" for n in names)))
    # one row for each different text, under its least id; blank texts are one
    one = F.when(F.col("blank"), "").otherwise(F.col("sha")).alias("copy")
    texts = prints.groupBy(one, "blank", *names).agg(F.min(F.struct("id", "sha")).alias("first"))
    texts = stash(texts.select("copy", "blank", *names, F.col("first.id").alias("id"), F.col("first.sha").alias("sha"), F.monotonically_increasing_id().alias("node")))
    candidates = stash(near_components(texts.filter("not blank").select(F.col("node").alias("doc_id"), *names), radius, lanes, beside))
    grouped = candidates.groupBy("component_id").count().filter("count > 1").select(F.col("component_id").bitwiseXOR(F.lit(0)).alias("component_id"))
    members = candidates.join(grouped, "component_id").select(F.col("doc_id").alias("node"), "component_id")
    members = members.join(texts, "node").select("node", "component_id", *names, "id", "sha")
    whole = documents.select(F.col("doc_id").cast("long").alias("id"), key.alias("sha"), "text")
    members = whole.join(members, ["id", "sha"]).dropDuplicates(["node"])
    group = components(_checked(members, names, words, radius, least, lanes, beside)).select(F.col("node"), F.col("component_id").alias("set"))
    placed = texts.join(group, "node", "left").select("copy", "id", "sha", F.coalesce("set", "node").alias("set"))
    first = placed.groupBy("set").agg(F.min(F.struct("id", "sha")).alias("first")).select(F.col("set").bitwiseXOR(F.lit(0)).alias("set"), "first")
    stays = placed.join(first, "set").select("copy", F.col("first.id").alias("first_id"), F.col("first.sha").alias("first_sha"))
    # every (id, text) that is not the first of its group
    pairs = prints.groupBy("id", "sha", one).agg(F.count("*").alias("rows"))
    judged = stash(pairs.join(stays, "copy").select("id", "sha", "rows", ((F.col("id") == F.col("first_id")) & (F.col("sha") == F.col("first_sha"))).alias("first")))
    mine = documents.withColumn("_key", F.struct(F.col("doc_id").cast("long").alias("id"), key.alias("sha")))
    gone = judged.filter("not first").select(F.struct("id", "sha").alias("_key"))
    left = mine.join(gone, "_key", "left_anti")
    twice = judged.filter("first and rows > 1").select(F.struct("id", "sha").alias("_key"))
    if not twice.isEmpty():
        left = left.join(twice, "_key", "left_anti").unionByName(left.join(twice, "_key", "left_semi").dropDuplicates(["_key"]))
    return left.select(documents.columns)
