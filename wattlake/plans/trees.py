"""Tree ensembles of many segments as one table of nodes, by which one look at the rows scores them all."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import shared_folder

#: Nodes that are broadcast at once; the segments of a larger table are scored in several looks.
MOST_NODES = 4_000_000
ENSEMBLES = (GBTRegressionModel, RandomForestRegressionModel)
KINDS = (DecisionTreeRegressionModel, *ENSEMBLES)
FIELDS = "segment string, tree int, id int, feature int, threshold double, left int, right int, value double"


def nodes(models: dict[str, object], path: str | None = None) -> DataFrame:
    """(segment, tree, id, feature, threshold, left, right, value) of every node of the *models*, each kept under *path* first.

    A leaf has feature -1 and its value times its tree's weight, so that a prediction is a sum
    over trees.  Splits by categories are an error: features of the library are numbers.
    """
    spark = SparkSession.active()
    path = path or f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}"
    parts, weights = [spark.createDataFrame([], FIELDS)], []
    for ensemble in (True, False):
        some = {s: m for s, m in models.items() if isinstance(m, ENSEMBLES) == ensemble}
        folders = {s: f"{path}/{ensemble:d}-{i:06d}" for i, s in enumerate(sorted(some))}
        for s, m in some.items():
            m.write().overwrite().save(folders[s])
            of_trees = [1.0] if not ensemble else [float(w) / (1 if isinstance(m, GBTRegressionModel) else len(m.trees)) for w in m.treeWeights]
            weights += [(s, t, w) for t, w in enumerate(of_trees)]
        if some:
            names = spark.createDataFrame([(f.rsplit("/", 1)[1], s) for s, f in folders.items()], "_folder string, segment string")
            n = "nodeData." if ensemble else ""
            read = spark.read.parquet(*[f"{f}/data" for f in folders.values()])
            rows = read.select(
                F.regexp_extract(F.input_file_name(), r"/(\d-\d{6})/data/", 1).alias("_folder"), (F.col("treeID") if ensemble else F.lit(0)).alias("tree"), F.col(f"{n}id").alias("id"),
                F.col(f"{n}split.featureIndex").alias("feature"), F.get(f"{n}split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col(f"{n}leftChild").alias("left"),
                F.col(f"{n}rightChild").alias("right"), F.col(f"{n}prediction").alias("value"), F.col(f"{n}split.numCategories").alias("_categories"),
            )
            checked = rows.withColumn("feature", F.when(F.col("_categories") > 0, F.raise_error(F.lit("a split by categories"))).otherwise(F.col("feature")))
            parts.append(checked.join(names, "_folder").select(*parts[0].columns))
    weighed = spark.createDataFrame(weights, "segment string, tree int, _w double")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    value = F.when(F.col("feature") < 0, F.col("value") * F.col("_w")).otherwise(F.lit(0.0))
    return every.join(weighed, ["segment", "tree"]).withColumn("value", value).select(*parts[0].columns)


class Forest:
    """The nodes of some segments in arrays; every segment has the roots of its trees."""

    def __init__(self, table: pd.DataFrame):
        table = table.sort_values(["segment", "tree", "id"], ignore_index=True)
        start = table.groupby(["segment", "tree"], sort=False)["id"].transform("size").to_numpy()
        first = np.flatnonzero(np.concatenate(([True], (table["segment"].to_numpy()[1:] != table["segment"].to_numpy()[:-1]) | (table["tree"].to_numpy()[1:] != table["tree"].to_numpy()[:-1]))) if len(table) else [])
        base = np.repeat(first, start[first]) if len(first) else np.zeros(0, int)  # ids count from a tree's root, without gaps
        self.feature, self.threshold, self.value = (table[c].to_numpy() for c in ("feature", "threshold", "value"))
        self.left, self.right = table["left"].to_numpy() + base, table["right"].to_numpy() + base
        self.roots = {s: first[i] for s, i in pd.Series(table["segment"].to_numpy()[first]).groupby(table["segment"].to_numpy()[first]).groups.items()} if len(first) else {}

    def score(self, segment: str, x: np.ndarray) -> np.ndarray:
        """The sum of the leaves that each row reaches; a value that isn't there goes to the right, as in Spark's own trees."""
        at = np.repeat(self.roots[segment][None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at].sum(1)
            with np.errstate(invalid="ignore"):
                left = x[rows, np.maximum(f, 0)] <= self.threshold[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)


def _scorer(forest):
    """The prediction of a segment's trees, as a function of its name and the inputs; null for other segments."""

    @F.pandas_udf("double")
    def score(name: pd.Series, x: pd.Series) -> pd.Series:
        out = np.full(len(name), np.nan)
        for s, at in name.groupby(name).indices.items():
            if s in forest.value.roots:
                out[at] = forest.value.score(s, np.stack(x.iloc[at].to_numpy()))
        return pd.Series(out).where(name.isin(list(forest.value.roots)), None)

    return score


def scored(df: DataFrame, table: DataFrame, segment: str, inputs: list[Column], out: str = "prediction", most: int = MOST_NODES) -> DataFrame:
    """*df* with the prediction of its segment's trees, null for segments without any, from the :func:`nodes` in *table*.

    One look at the rows serves all segments whose nodes fit *most* together.  Beyond that
    segments are scored in lots of about *most* nodes, a look each; a single segment's nodes are what
    its depth and number of trees allow.
    """
    spark, lots, size = df.sparkSession, [[]], 0
    for r in table.groupBy("segment").count().orderBy("segment").collect():
        if lots[-1] and size + r["count"] > most:
            lots, size = [*lots, []], 0
        lots[-1].append(r["segment"])
        size += r["count"]
    parts = []
    for i, lot in enumerate(lots):
        forest = spark.sparkContext.broadcast(Forest(table.filter(F.col("segment").isin(*lot)).toPandas()))

        score = _scorer(forest)
        own = F.coalesce(F.col(segment).isin(*lot), F.lit(False))
        if len(lots) > 1:  # a segment that is in none goes with the first
            others = ~F.coalesce(F.col(segment).isin(*[s for x in lots for s in x]), F.lit(False))
            rows = df.filter(own | others if i == 0 else own)
        else:
            rows = df
        parts.append(rows.withColumn(out, score(F.col(segment), F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in inputs]))))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every
