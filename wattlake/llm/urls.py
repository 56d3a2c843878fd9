"""URL filters: rules first, then a path-template tree for each host with smoothed labelled purity."""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.llm.common import forget, stash

#: (verdict, host, path): a rule fits its host and all subdomains if the path begins with the rule's; the longest wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: A segment is a branch of its own if it has so many labelled pages at its place in the host's tree, or this share of its place's pages (and so many), or this share of those at its depth over all hosts.
OWN_LABELLED, OWN_SHARE, OWN_PAGES, ALL_SHARE = 8, 0.05, 3, 0.005
#: Sibling branches are merged if their labelled shares differ by less than so many standard errors.
ALIKE = 1.96
#: Pages that a template's parent counts for in its purity, and the purity from which it is rejected.
WEIGHT, REJECT = 4.0, 0.5
#: Merged segments that a template names; of more it names the first, and their number and hash.
NAMED = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def _rule(rules: tuple) -> tuple[Column, Column]:
    """The rule (like ``net/``) that fits, else null, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path))
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row of *pages* (page_id, url).

    What a rule decides is the labelled part.  Each host's paths form a tree of segments, built a
    level at a time down to the deepest: segments that are rare become ``*``, and sibling
    branches whose labelled shares are alike (a two-proportion test) become one branch.  A node's
    share of blocked labelled pages is smoothed by that of the node above it, the host's by that
    of all pages.  A template's purity is its own share, smoothed by that of the same unmerged
    template over all hosts, which is smoothed by its node's; unlabelled pages are blocked from
    REJECT on.  Null urls and those without ``://`` have an empty host and path and
    are judged as such; without any labelled page all is allowed.  Counts are aggregated before
    they are shuffled, and a common host is only ever on the side of joins that can be split.
    Each level is written to the shared folder and goes on with the pages that are deeper.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = _rule(rules)
    rows = rows.withColumn("rule", rule).withColumn("_given", verdict)
    rows = rows.withColumn("_segments", F.filter(F.split("path", "/", -1), lambda s: s != ""))
    rows = rows.withColumn("template", F.lit("")).withColumn("_shape", F.lit(""))
    rows = rows.withColumn("_block", F.coalesce((F.col("_given") == "block").cast("int"), F.lit(0))).withColumn("_known", F.col("_given").isNotNull().cast("int"))
    rows = stash(rows)
    all_known = rows.agg(F.sum("_block"), F.sum("_known")).first()
    base = (all_known[0] or 0) / all_known[1] if all_known[1] else 0.0
    hosts = rows.groupBy("host").agg(_smoothed(F.sum("_block"), F.sum("_known"), F.lit(base)).alias("_node"))
    active, done, level = rows.join(_anew(hosts, "host"), "host"), [], 0
    while True:
        deeper = F.size("_segments") > level
        if active.filter(deeper).limit(OWN_PAGES).count() < OWN_PAGES:  # too few for any branch
            tail = F.repeat(F.lit("/*"), F.size("_segments") - level)
            done.append(active.withColumn("template", F.concat("template", tail)).withColumn("_shape", F.concat("_shape", tail)))
            break
        done.append(stash(active.filter(~deeper).drop("_segments")))
        scrap = [active]
        active = stash(_grown(active.filter(deeper), level, scrap))
        forget(*scrap)
        level += 1
    rows = reduce(DataFrame.unionByName, [d.drop("_segments") for d in done])
    # one row for each template of each host, from which the shapes are summed; joined to those before the pages are
    own = stash(rows.groupBy("host", "template", "_shape").agg(F.sum("_block").alias("b"), F.sum("_known").alias("n"), F.max("_node").alias("_node")))
    shapes = own.groupBy("_shape").agg(F.sum("b").alias("_sb"), F.sum("n").alias("_sn"))
    merged = own.groupBy("host", "template").agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
    over = _smoothed(F.col("_sb"), F.col("_sn"), F.col("_node"))
    purity = own.drop("b", "n").join(merged, ["host", "template"]).join(shapes, "_shape").select("host", "template", "_shape", _smoothed(F.col("b"), F.col("n"), over).alias("purity"))
    judged = rows.join(purity, ["host", "template", "_shape"])
    decided = F.coalesce("_given", F.when(F.col("purity") >= REJECT, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", decided.alias("verdict"), F.when(F.col("template") == "", "/").otherwise(F.col("template")).alias("template"), "purity")


def _anew(df: DataFrame, *keys: str) -> DataFrame:
    """*df* with keys that count as others: sums joined back to what they are sums of are dealt out again, so that the join can split a common key."""
    return df.withColumns({k: F.concat(k, F.lit("")) if dict(df.dtypes)[k] == "string" else F.col(k).bitwiseXOR(F.lit(0)) for k in keys})


def _smoothed(blocked: Column, known: Column, by: Column) -> Column:
    """The share of blocked pages, with WEIGHT pages more that are as *by* is."""
    return (blocked + WEIGHT * by) / (known + WEIGHT)


def _grown(rows: DataFrame, level: int, scrap: list[DataFrame]) -> DataFrame:
    """*rows*, all of which have a segment at *level*, with ``template`` (merged) and ``_shape`` (unmerged) a segment longer, and the share of their new ``_node``; *scrap* gets what was written on the way."""
    place = ["host", "template"]
    rows = rows.withColumn("_segment", F.get("_segments", F.lit(level)))
    counts = stash(rows.groupBy(*place, "_segment").agg(F.count("*").alias("c"), F.sum("_block").alias("b"), F.sum("_known").alias("k")))
    scrap.append(counts)
    total = counts.agg(F.sum("c")).first()[0]
    # at most 1 / ALL_SHARE segments of a level are common over all hosts
    common = counts.groupBy("_segment").agg(F.sum("c").alias("c")).filter(F.col("c") >= max(OWN_PAGES, ALL_SHARE * total)).select("_segment", F.lit(True).alias("_common"))
    nodes = counts.groupBy(*place).agg(F.sum("c").alias("all"))
    own = (F.col("k") >= OWN_LABELLED) | ((F.col("c") >= OWN_PAGES) & (F.col("c") >= OWN_SHARE * F.col("all")))
    kept = counts.join(F.broadcast(common), "_segment", "left").join(_anew(nodes, *place), place).filter(F.col("_common").isNotNull() | own)
    kept = kept.withColumn("_share", F.try_divide("b", "k"))
    # shares with labels in their order, a row for each: a new branch begins where a share differs from the one before
    order = Window.partitionBy(*place).orderBy("_share")
    shares = kept.filter("k > 0").groupBy(*place, "_share").agg(F.sum("b").alias("b"), F.sum("k").alias("k"))
    pooled = (F.col("b") + F.lag("b").over(order)) / (F.col("k") + F.lag("k").over(order))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("k") + 1 / F.lag("k").over(order)))
    new = F.coalesce(F.abs(F.col("_share") - F.lag("_share").over(order)) > ALIKE * error, F.lit(True)).cast("int")
    branch = F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    shares = shares.withColumn("_new", new).select(*place, "_share", branch.alias("_branch"))
    labelled = kept.filter("k > 0").join(_anew(shares, *place), [*place, "_share"]).select(*place, "_segment", "_branch", "b", "k")
    sums = [F.count("*").alias("_n"), F.min("_segment").alias("_first"), F.bit_xor(F.xxhash64("_segment")).alias("_x"), F.sum("b").alias("_b"), F.sum("k").alias("_k")]
    sizes = labelled.groupBy(*place, "_branch").agg(*sums)
    few = labelled.join(_anew(sizes.filter(F.col("_n") <= NAMED).select(*place, "_branch"), *place, "_branch"), [*place, "_branch"])
    listed = few.groupBy(*place, "_branch").agg(F.array_join(F.sort_array(F.collect_list("_segment")), "|").alias("_list"))
    long = F.concat("_first", F.lit("|+"), (F.col("_n") - 1).cast("string"), F.lit("#"), F.lower(F.hex("_x")))
    names = sizes.join(listed, [*place, "_branch"], "left").select(*place, "_branch", F.coalesce("_list", long).alias("_name"), "_b", "_k")
    branches = labelled.drop("b", "k").join(_anew(names, *place, "_branch"), [*place, "_branch"]).select(*place, "_segment", "_name", "_b", "_k")
    branches = branches.unionByName(kept.filter("k = 0").select(*place, "_segment", F.col("_segment").alias("_name"), F.col("b").alias("_b"), F.col("k").alias("_k")))
    # what is no branch is ``*``, with the sums of all of it
    named = stash(counts.join(branches, [*place, "_segment"], "left"))
    scrap.append(named)
    rest = F.col("_name").isNull()
    stars = named.filter(rest).groupBy(*place).agg(F.sum("b").alias("_rb"), F.sum("k").alias("_rk"))
    wild = named.filter(rest).select(*place, "_segment").join(_anew(stars, *place), place).select(*place, "_segment", F.lit("*").alias("_name"), F.col("_rb").alias("_b"), F.col("_rk").alias("_k"), F.lit("*").alias("_kind"))
    known = named.filter(~rest).select(*place, "_segment", "_name", "_b", "_k", F.col("_segment").alias("_kind"))
    grown = rows.join(known.unionByName(wild), [*place, "_segment"])
    grown = grown.withColumn("_node", _smoothed(F.col("_b"), F.col("_k"), F.col("_node"))).withColumn("_shape", F.concat("_shape", F.lit("/"), "_kind"))
    return grown.withColumn("template", F.concat("template", F.lit("/"), "_name")).drop("_segment", "_name", "_kind", "_b", "_k")
