"""Geographic neighbourhoods, clusters and nearest assignment."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.functions.scalars import EARTH_KM, haversine_km
from wattlake.operators.sampling import numbered
from wattlake.session import stash

LAT, LON, AXES = "latitude", "longitude", ("x", "y", "z")
#: Times that a cell of points is parted in 64 before its points themselves are compared.
LEVELS = 3


def coordinates(df: DataFrame) -> DataFrame:
    """Distinct coordinates without nulls."""
    return df.select(LAT, LON).filter(f"{LAT} is not null and {LON} is not null").distinct()


def neighbours(points: DataFrame, radius_km: float) -> DataFrame:
    """(lat_a, lon_a, lat_b, lon_b, km) of the other points within the radius of each, both ways.

    Points meet in cells of the sphere's surrounding cube whose edge is the radius, so that a
    neighbour is in one of the 27 cells around; there is no seam at the poles or the date line.
    """
    r = [F.radians(F.col(LAT)), F.radians(F.col(LON))]
    xyz = [F.cos(r[0]) * F.cos(r[1]), F.cos(r[0]) * F.sin(r[1]), F.sin(r[0])]
    edge = 2 * math.sin(min(radius_km / EARTH_KM, math.pi) / 2) * (1 + 1e-9) or 1e-12
    cell = [F.floor(c / edge) for c in xyz]
    a = points.select(F.col(LAT).alias("lat_a"), F.col(LON).alias("lon_a"), *[c.alias(f"c{i}") for i, c in enumerate(cell)])
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    b = points.select(F.col(LAT).alias("lat_b"), F.col(LON).alias("lon_b"), *[c.alias(f"k{i}") for i, c in enumerate(cell)])
    for i, key in enumerate(("k0", "k1", "k2")):
        b = b.select("*", F.explode(F.transform(around, lambda step: F.col(key) + step)).alias(f"c{i}"))
    km = haversine_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b"))
    pairs = a.join(b, ["c0", "c1", "c2"]).filter("lat_a <> lat_b or lon_a <> lon_b")
    return pairs.select("lat_a", "lon_a", "lat_b", "lon_b", km.alias("km")).filter(F.col("km") <= radius_km)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root): the least node that each of *nodes* reaches by *edges* (a, b), given both ways.

    Labels spread along edges and then jump to their own label's label; each round is kept in
    the checkpoint folder.
    """
    labels = stash(nodes.select("node", F.col("node").alias("root")))
    edges = stash(edges.select("a", "b"))
    while True:
        near = edges.join(labels, edges["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_m"))
        spread = labels.join(near, "node", "left").select("node", F.least("root", F.coalesce("_m", "root")).alias("root"))
        up = spread.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        new = stash(spread.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root")))
        changed = new.join(labels.withColumnRenamed("root", "_old"), "node").filter("root <> _old").limit(1).count()
        labels = new
        if not changed:
            return labels


def _on_sphere(lat: str, lon: str) -> list[Column]:
    """x, y and z of a coordinate on the unit sphere."""
    a, b = F.radians(F.col(lat)), F.radians(F.col(lon))
    return [F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)]


def _box_pairs(pairs: DataFrame, chord: float) -> DataFrame:
    """Pairs of boxes (a_low_x .. b_high_z) with how near at least and how far at most their points are from each other."""
    least = [F.greatest(F.col(f"a_low_{x}") - F.col(f"b_high_{x}"), F.col(f"b_low_{x}") - F.col(f"a_high_{x}"), F.lit(0.0)) for x in AXES]
    most = [F.greatest(F.col(f"a_high_{x}") - F.col(f"b_low_{x}"), F.col(f"b_high_{x}") - F.col(f"a_low_{x}")) for x in AXES]
    length = lambda d: F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    # a hair's breadth apart from the bound is left to the points themselves
    return pairs.withColumn("_near", length(most) <= chord * (1 - 1e-9)).withColumn("_far", length(least) > chord * (1 + 1e-9))


def _linked_cells(points: DataFrame, chord: float, radius_km: float) -> DataFrame:
    """(a, b) of cells (by their first points) of *points* that have points within the radius of each other.

    Two cells are linked as soon as the boxes of their points, or of the points of two of their
    parts, are wholly within the radius, and parted if all are beyond it; only what is undecided
    is looked at in smaller parts, and at last by points.
    """

    def boxes(level: int) -> DataFrame:
        part = F.struct(*[F.shiftright(f"_f{x}", 2 * (LEVELS - level)).alias(x) for x in AXES])
        ends = [f(f"_{x}").alias(f"{name}_{x}") for x in AXES for name, f in (("low", F.min), ("high", F.max))]
        above = F.struct(*[F.shiftright(F.col(f"_part.{x}"), 2).alias(x) for x in AXES])
        return points.groupBy("first", part.alias("_part")).agg(*ends).withColumn("_above", above)

    side = lambda df, s: df.withColumnsRenamed({c: f"{s}{c}" if c[0] == "_" else f"{s}_{c}" for c in df.columns})
    top = boxes(0)
    reach = F.array(*[F.lit(i) for i in range(-2, 3)])
    spread = top
    for x in AXES:
        spread = spread.withColumn(f"_{x}", F.explode(F.transform(reach, _shifted(x))))
    spread = spread.withColumn("_there", F.struct(*[F.col(f"_{x}").alias(x) for x in AXES])).drop(*[f"_{x}" for x in AXES])
    met = side(spread, "a").join(side(top, "b"), F.col("a_there") == F.col("b_part")).filter("a_first < b_first").drop("a_there")
    linked = None
    for level in range(1, LEVELS + 2):
        met = stash(_box_pairs(met, chord))
        new = met.filter("_near").select(F.col("a_first").alias("a"), F.col("b_first").alias("b")).distinct()
        linked = new if linked is None else linked.unionByName(new)
        open_ = met.filter("not _near and not _far").select("a_first", "b_first", "a_part", "b_part")
        open_ = open_.join(new, (open_["a_first"] == new["a"]) & (open_["b_first"] == new["b"]), "left_anti")
        if level <= LEVELS:
            parts = boxes(level)
            left, right = side(parts, "a"), side(parts, "b")
            open_ = open_.withColumnsRenamed({"a_first": "_a", "b_first": "_b", "a_part": "_ap", "b_part": "_bp"})
            met = open_.join(left, (F.col("_a") == F.col("a_first")) & (F.col("_ap") == F.col("a_above"))).join(right, (F.col("_b") == F.col("b_first")) & (F.col("_bp") == F.col("b_above"))).drop("_a", "_b", "_ap", "_bp", "a_above", "b_above")
    finest = points.select("first", F.struct(*[F.col(f"_f{x}").alias(x) for x in AXES]).alias("_part"), LAT, LON)
    left = finest.select(F.col("first").alias("a_first"), F.col("_part").alias("a_part"), F.col(LAT).alias("lat_a"), F.col(LON).alias("lon_a"))
    right = finest.select(F.col("first").alias("b_first"), F.col("_part").alias("b_part"), F.col(LAT).alias("lat_b"), F.col(LON).alias("lon_b"))
    near = haversine_km(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")) <= radius_km
    exact = open_.join(left, ["a_first", "a_part"]).join(right, ["b_first", "b_part"]).filter(near)
    return linked.unionByName(exact.select(F.col("a_first").alias("a"), F.col("b_first").alias("b")).distinct())


def _shifted(axis: str):
    return lambda step: F.col(f"_part.{axis}") + step


def clusters(df: DataFrame, radius_km: float = 40.0, min_samples: int = 2) -> DataFrame:
    """(latitude, longitude, grupo_regional, is_core) of each distinct coordinate: density-based clusters.

    A point with *min_samples* points in its radius (itself one of them) is a core; cores within
    the radius of each other are one cluster; another point joins the first cluster of a core in
    its radius; one that has none is a group of its own.  Clusters are numbered by their first
    core in order of coordinates, lone points after them.

    Points lie in cells whose diagonal is the radius.  All points of a cell with *min_samples*
    points are cores of one cluster, one node however many they are; other cells have fewer
    points than that, and only those are compared with the points around them.  So no step
    writes all pairs of a dense place.
    """
    chord = 2 * math.sin(min(radius_km / EARTH_KM, math.pi) / 2) or 1e-12
    edge = chord / math.sqrt(3) * (1 - 1e-9)
    xyz = dict(zip(AXES, _on_sphere(LAT, LON), strict=True))
    node = F.struct(F.col(LAT).alias("lat"), F.col(LON).alias("lon"))
    points = coordinates(df).withColumn("node", node).withColumns({f"_{x}": c for x, c in xyz.items()})
    points = points.withColumns({f"_f{x}": F.floor(F.col(f"_{x}") / edge * 4**LEVELS).cast("long") for x in AXES})
    points = points.withColumn("cell", F.struct(*[F.shiftright(f"_f{x}", 2 * LEVELS).alias(x) for x in AXES]))
    cells = points.groupBy("cell").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    points = stash(points.join(cells, "cell").withColumn("dense", F.col("n") >= min_samples))
    sparse, dense = points.filter("not dense"), points.filter("dense")
    reach = F.array(*[F.lit(i) for i in range(-2, 3)])
    spread = sparse.select(F.col("node").alias("p"), F.col("cell").alias("_part"), *[F.col(c).alias(f"{c}_p") for c in (LAT, LON)])
    for x in AXES:
        spread = spread.withColumn(f"_{x}", F.explode(F.transform(reach, _shifted(x))))
    spread = spread.withColumn("cell", F.struct(*[F.col(f"_{x}").alias(x) for x in AXES])).drop("_part", *[f"_{x}" for x in AXES])
    other = points.select("cell", F.col("node").alias("q"), F.when(F.col("dense"), F.col("first")).otherwise(F.col("node")).alias("q_node"), "dense", LAT, LON)
    km = haversine_km(F.col(f"{LAT}_p"), F.col(f"{LON}_p"), F.col(LAT), F.col(LON))
    near = stash(spread.join(other, "cell").filter((F.col("p") != F.col("q")) & (km <= radius_km)).select("p", "q", "q_node", "dense"))
    degree = near.groupBy("p").agg(F.count("*").alias("d"))
    cores = stash(degree.filter(F.col("d") + 1 >= min_samples).select(F.col("p").alias("core")))
    to_core = near.join(cores, near["q"] == cores["core"], "left").filter("dense or core is not null").select("p", "q_node")
    one_way = to_core.join(cores, to_core["p"] == cores["core"], "left_semi").select(F.col("p").alias("a"), F.col("q_node").alias("b")).unionByName(_linked_cells(dense, chord, radius_km))
    both = one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    nodes = dense.select(F.col("first").alias("node")).distinct().unionByName(cores.select(F.col("core").alias("node")))
    roots = components(both, nodes)
    own = dense.select("node", F.col("first").alias("_n")).unionByName(cores.select(F.col("core").alias("node"), F.col("core").alias("_n")))
    core = own.join(roots.withColumnRenamed("node", "_n"), "_n").select("node", "root", F.lit(True).alias("is_core"))
    touched = to_core.join(cores, to_core["p"] == cores["core"], "left_anti").join(roots, F.col("q_node") == roots["node"])
    border = touched.groupBy(F.col("p").alias("node")).agg(F.min("root").alias("root")).withColumn("is_core", F.lit(False))
    placed = stash(core.unionByName(border))
    lone = points.select("node").join(placed, "node", "left_anti")
    first = placed.select(F.lit(0).alias("_k"), F.col("root").alias("node")).distinct().unionByName(lone.select(F.lit(1).alias("_k"), "node"))
    numbers = numbered(first, ["_k", "node"], "_n").select(F.col("node").alias("root"), F.col("_n").cast("int").alias("grupo_regional"))
    everyone = placed.unionByName(lone.select("node", F.col("node").alias("root"), F.lit(False).alias("is_core")))
    return everyone.join(numbers, "root").select(F.col("node.lat").alias(LAT), F.col("node.lon").alias(LON), "grupo_regional", "is_core")


def nearest(queries: DataFrame, reference: DataFrame) -> DataFrame:
    """(latitude, longitude, grupo_regional): for each coordinate of *queries* the group of the nearest of *reference*; of equally near the least coordinate.

    The reference's points lie in cells of the cube around the sphere, each of 64 parts of the
    one above it.  From the top down, a query goes on to the cells that can hold its nearest
    point: whose box is no farther than the farthest point of the best box.  So it meets the
    points of a few small cells, however many there are and wherever they crowd.
    """
    n = reference.count()
    depth = min(10, max(1, math.ceil(math.log(max(n, 1), 16))))
    side, names = 4**depth, ("x", "y", "z")
    cells = [F.least(F.floor((c + 1) / 2 * side), F.lit(side - 1)).cast("long") for c in _on_sphere(LAT, LON)]
    # two bits of each axis a level, the top level first
    code = F.lit(0).cast("long")
    for level in range(depth):
        for axis, c in enumerate(cells):
            code = code.bitwiseOR(F.shiftleft(F.shiftright(c, 2 * level).bitwiseAND(F.lit(3)), 6 * level + 2 * axis))
    points = reference.select(F.col(LAT).alias("_lat"), F.col(LON).alias("_lon"), F.col("grupo_regional").alias("_g"), code.alias("_cell"), *[c.alias(f"_{a}") for a, c in zip(names, _on_sphere(LAT, LON), strict=True)])
    points = stash(points)
    found = queries.select(LAT, LON, *[c.alias(a) for a, c in zip(names, _on_sphere(LAT, LON), strict=True)])
    for level in range(1, depth + 1):
        part = points.withColumn("_cell", F.shiftright("_cell", 6 * (depth - level)))
        boxes = part.groupBy("_cell").agg(*[f(f"_{a}").alias(f"_{k}{a}") for a in names for k, f in (("low", F.min), ("high", F.max))])
        if level == 1:  # 64 boxes at most
            met = found.crossJoin(F.broadcast(boxes))
        else:
            met = found.withColumnRenamed("_cell", "_up").join(boxes.withColumn("_up", F.shiftright("_cell", 6)), "_up").drop("_up")
        gap = [F.greatest(F.col(f"_low{a}") - F.col(a), F.col(a) - F.col(f"_high{a}"), F.lit(0.0)) for a in names]
        span = [F.greatest(F.abs(F.col(a) - F.col(f"_low{a}")), F.abs(F.col(a) - F.col(f"_high{a}"))) for a in names]
        least, most = (F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]) for d in (gap, span))
        best = F.min(most).over(Window.partitionBy(LAT, LON))
        found = met.withColumn("_best", best).filter(least <= F.col("_best") + 1e-9).select(LAT, LON, *names, "_cell")
    km = haversine_km(F.col(LAT), F.col(LON), F.col("_lat"), F.col("_lon"))
    return found.join(points.select("_cell", "_lat", "_lon", "_g"), "_cell").groupBy(LAT, LON).agg(F.min_by("_g", F.struct(F.round(km, 9), "_lat", "_lon")).alias("grupo_regional"))


def assign(df: DataFrame, reference: DataFrame) -> DataFrame:
    """*df* with grupo_regional: that of the equal reference coordinate, else of the nearest; null without a coordinate.

    Only distinct unseen coordinates are searched for; *reference* has a row for each known one.
    """
    ref = reference.select(F.col(LAT).alias("_lat"), F.col(LON).alias("_lon"), F.col("grupo_regional").alias("_g"))
    exact = df.join(ref, (df[LAT] == ref["_lat"]) & (df[LON] == ref["_lon"]), "left").drop("_lat", "_lon")
    unseen = coordinates(df).join(reference.select(LAT, LON), [LAT, LON], "left_anti")
    found = nearest(unseen, reference).withColumnRenamed("grupo_regional", "_n")
    return exact.join(found, [LAT, LON], "left").withColumn("grupo_regional", F.coalesce("_g", "_n")).drop("_g", "_n")


def save_mapping(clustered: DataFrame, path: str) -> None:
    """Writes the reference of groups (latitude, longitude, grupo_regional) as Parquet, in order of coordinates in each file."""
    clustered.select(LAT, LON, F.col("grupo_regional").cast("int").alias("grupo_regional")).sortWithinPartitions(LAT, LON).write.mode("overwrite").parquet(path)


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """The reference of groups that :func:`save_mapping` has written."""
    return spark.read.schema(f"{LAT} double, {LON} double, grupo_regional int").parquet(path)


def summary(clustered: DataFrame) -> DataFrame:
    """One row a group: mean coordinate, points, and whether it is a lone point."""
    return clustered.groupBy("grupo_regional").agg(F.avg(LAT).alias("lat_media"), F.avg(LON).alias("lon_media"), F.count("*").alias("n_pontos"), (F.count("*") == 1).alias("is_isolado"))
