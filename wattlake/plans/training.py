"""Training, comparing and scoring regressors with Spark ML, over all rows or one a segment."""

from __future__ import annotations

import itertools
import random
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.machines import UNKNOWN
from wattlake.functions.scalars import label_or, safe_name
from wattlake.operators import gram
from wattlake.operators.metrics import error_metrics, ranked, weighted
from wattlake.operators.sampling import bucket, numbered, with_split
from wattlake.plans import trees
from wattlake.session import forget, stash

MODELS = {"gbt": GBTRegressor, "forest": RandomForestRegressor, "linear": LinearRegression, "tree": DecisionTreeRegressor}
#: Values that a search draws from, by model.
GRIDS = {
    "gbt": {"maxDepth": [3, 5, 7], "maxIter": [20, 50], "stepSize": [0.05, 0.1]},
    "forest": {"maxDepth": [5, 8, 10], "numTrees": [20, 50]},
    "linear": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
    "tree": {"maxDepth": [3, 5, 8]},
}


@dataclass
class Config:
    """What is fitted on which columns; without *features* the rows bring a vector ``_features``."""

    features: list[str] | None
    target: str = "consumo_kwh"
    key: str = "row_key"
    segment: str = "tipo_maquina"
    test: float = 0.15
    folds: int = 3
    draws: int = 2
    seed: int = 42
    models: list[str] = field(default_factory=lambda: ["linear", "tree"])
    params: dict[str, dict] = field(default_factory=dict)
    least_rows: int = 50
    parallelism: int = 4


def draws(grid: dict[str, list], n: int, seed: int) -> list[dict]:
    """*n* different combinations of a grid (all, if it has no more), the same for a seed."""
    every = [dict(zip(sorted(grid), v, strict=True)) for v in itertools.product(*[grid[k] for k in sorted(grid)])]
    return every if len(every) <= n else random.Random(seed).sample(every, n)


class Mape(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """The mean absolute percentage error, as :func:`error_metrics` has it; infinite where there are no rows to judge by."""

    labelCol = Param(Params._dummy(), "labelCol", "column of the actual values", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the predictions", TypeConverters.toString)

    def __init__(self, labelCol: str = "consumo_kwh", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        r = error_metrics(dataset, self.getOrDefault("labelCol"), self.getOrDefault("predictionCol")).first()
        return float("inf") if r is None or r["MAPE"] is None else r["MAPE"]

    def isLargerBetter(self) -> bool:
        return False


def pipeline(name: str, config: Config, params: dict | None = None) -> Pipeline:
    model = MODELS[name](featuresCol="_features", labelCol=config.target, predictionCol="prediction", **(params or config.params.get(name, {})))
    assembled = [] if config.features is None else [VectorAssembler(inputCols=config.features, outputCol="_features", handleInvalid="keep")]
    return Pipeline(stages=[*assembled, model])


def fit(df: DataFrame, config: Config, name: str, params: dict | None = None) -> PipelineModel:
    return pipeline(name, config, params).fit(df)


def tune(df: DataFrame, config: Config, name: str) -> tuple[PipelineModel, dict, float]:
    """The best of some drawn parameters by mean MAPE over folds that the key decides, fitted again on all rows.

    Several fits run at once (``config.parallelism``), on rows that are kept while they do.
    """
    drawn = draws(GRIDS[name], config.draws, config.seed)
    whole = pipeline(name, config)
    model = whole.getStages()[-1]
    maps = [{model.getParam(k): v for k, v in params.items()} for params in drawn]
    needed = [config.target, *(["_features"] if config.features is None else config.features)]
    rows = stash(df.select(*needed, F.pmod(bucket(config.key, config.seed + 1), F.lit(config.folds)).cast("int").alias("_fold")))
    search = CrossValidator(estimator=whole, estimatorParamMaps=maps, evaluator=Mape(config.target), numFolds=config.folds, foldCol="_fold", parallelism=config.parallelism)
    found = search.fit(rows)
    forget(rows)
    best = min(range(len(drawn)), key=lambda i: found.avgMetrics[i])
    return found.bestModel, drawn[best], found.avgMetrics[best]


def compare(df: DataFrame, config: Config, search: bool = False) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """(model, metrics on the shared test rows, n_train, n_test, rank) and the fitted models; least MAPE ranks first.

    The rows are kept while models are fitted, several at once (``config.parallelism``); one look
    at the test rows judges all models.
    """
    rows = stash(with_split(df, config.key, config.test, 0.0, config.seed))
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    if search:  # which has several fits at once itself
        models = {name: tune(train, config, name)[0] for name in config.models}
    else:
        one = inheritable_thread_target(df.sparkSession)(lambda name: fit(train, config, name))
        with ThreadPool(max(1, min(config.parallelism, len(config.models)))) as pool:
            models = dict(zip(config.models, pool.map(one, config.models), strict=True))
    judged = test
    for name, m in models.items():
        had = [] if config.features is None else ["_features"]
        judged = m.transform(judged).drop(*had).withColumnRenamed("prediction", f"_by_{name}")
    each = judged.select(config.target, F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"_by_{n}").alias("prediction")) for n in models])).alias("_p")).select(config.target, "_p.*")
    found = stash(error_metrics(each, config.target, "prediction", ["model"]).withColumnRenamed("n", "n_test").withColumn("n_train", F.lit(train.count())))
    forget(rows)
    return ranked(found), models


def line_models(df: DataFrame, config: Config) -> tuple[DataFrame, DataFrame]:
    """Linear models of all segments at once: (segment, n, intercept, coefficients), and the report of :func:`fit_segments`.

    One look at the training rows sums up every segment, one at the test rows judges them, however
    many segments there are; a segment with less than ``least_rows`` rows has no line but a reason.
    """
    rows = with_split(df.withColumn(config.segment, label_or(config.segment, UNKNOWN)), config.key, config.test, 0.0, config.seed)
    enough = F.col("_n") >= config.least_rows
    sizes = stash(rows.groupBy(F.col(config.segment).alias("segment")).agg(F.count("*").alias("_n")))
    lines = gram.lines(rows.filter("split = 'train'"), config.features, config.target, config.segment)
    lines = stash(lines.join(sizes.filter(enough).select("segment"), "segment"))
    scored = line_scores(rows.filter("split = 'test'"), lines, config)
    report = error_metrics(scored, config.target, "prediction", [config.segment]).withColumnRenamed("n", "n_test").withColumnRenamed(config.segment, "segment")
    skipped = sizes.select("segment", F.when(~enough, F.concat(F.col("_n").cast("string"), F.lit(" rows"))).alias("skipped"))
    return lines, skipped.join(lines.select("segment", F.col("n").alias("n_train")), "segment", "left").join(report, "segment", "left").withColumn("model", F.lit("linear"))


def line_scores(df: DataFrame, lines: DataFrame, config: Config) -> DataFrame:
    """Rows with the prediction of their segment's line, null where there is none; the planner chooses how to join them."""
    own = lines.select(F.col("segment").alias(config.segment), F.col("intercept").alias("_at0"), F.col("coefficients").alias("_by"))
    value = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in config.features]
    score = sum((F.get("_by", F.lit(i)) * v for i, v in enumerate(value)), F.lit(0.0)) + F.col("_at0")
    return df.withColumn(config.segment, label_or(config.segment, UNKNOWN)).join(own, config.segment, "left").withColumn("prediction", score).drop("_at0", "_by")


def fit_segments(df: DataFrame, config: Config) -> tuple[dict[str, PipelineModel], DataFrame]:
    """One best model a segment, and the report (segment, model, metrics; a reason where a segment was left out).

    What the fits need of the rows is computed and kept once; each segment's rows are taken from that.
    """
    needed = [config.key, config.target, *(["_features"] if config.features is None else config.features)]
    columns = dict.fromkeys(c for c in needed if c != config.segment)
    rows = stash(df.select(label_or(config.segment, UNKNOWN).alias(config.segment), *[F.col(f"`{c}`") for c in columns]))
    sizes = {r[0]: r[1] for r in rows.groupBy(config.segment).count().orderBy(config.segment).collect()}
    best, reports = {}, []
    for name, n in sizes.items():
        if n < config.least_rows:
            continue
        report, models = compare(rows.filter(F.col(config.segment) == name), config)
        best[name] = models[report.filter("rank = 1").first()["model"]]
        reports.append(report.withColumn("segment", F.lit(name)))
    forget(rows)
    skipped = df.sparkSession.createDataFrame([(s, f"{n} rows") for s, n in sizes.items() if n < config.least_rows], "segment string, skipped string")
    out = None
    for r in reports:
        out = r if out is None else out.unionByName(r)
    return best, (skipped if out is None else out.join(skipped, "segment", "full"))


def consolidated_report(report: DataFrame) -> DataFrame:
    """One row: the best models' metrics, weighed by test rows."""
    return weighted(report.filter("rank = 1"), ["MAE", "RMSE", "MAPE", "WMAPE", "Acuracia"])


def predict_segments(df: DataFrame, models: dict[str, PipelineModel], config: Config, order: list | None = None) -> DataFrame:
    """Each row scored by its segment's model; an unknown segment is an error.

    Linear models are a table that the rows are joined to and trees a table of nodes, so one look
    at the rows serves all segments of both.  With *order*, rows get their place in it (from 0) as
    ``row_number`` beforehand and come back sorted by that.
    """
    if order:
        return predict_segments(numbered(df, order, "row_number"), models, config).orderBy("row_number")
    rows = df.withColumn(config.segment, label_or(config.segment, UNKNOWN))
    unknown = rows.filter(~F.col(config.segment).isin(*models)).select(config.segment).distinct().limit(5).collect()
    if unknown:
        raise ValueError(f"no model for {[r[0] for r in unknown]}")
    last = {name: m.stages[-1] for name, m in models.items()}
    linear = [(name, float(m.intercept), [float(x) for x in m.coefficients.toArray()]) for name, m in last.items() if isinstance(m, LinearRegressionModel)]
    lines = rows.sparkSession.createDataFrame(linear, "segment string, intercept double, coefficients array<double>")
    scored = line_scores(rows, lines, config)
    of_trees = {name: m for name, m in last.items() if isinstance(m, trees.KINDS)}
    if not of_trees:
        return scored
    both = trees.scored(scored, trees.nodes(of_trees), config.segment, [F.col(f"`{c}`") for c in config.features], "_of_trees")
    return both.withColumn("prediction", F.coalesce("_of_trees", "prediction")).drop("_of_trees")


def predict_both(df: DataFrame, whole: PipelineModel, segment: PipelineModel, name: str, config: Config) -> DataFrame:
    """Adds global_prediction, and segment_prediction for the rows of that segment (null for others)."""
    scored = whole.transform(df).withColumnRenamed("prediction", "global_prediction").drop("_features")
    own = segment.transform(df.filter(F.col(config.segment) == name)).select(config.key, F.col("prediction").alias("segment_prediction"))
    return scored.join(own, config.key, "left")


def save(models: dict[str, PipelineModel], path: str, config: Config | None = None) -> DataFrame:
    """Writes each model under a safe name, and the manifest (segment, folder, features, target) as Parquet; returns the manifest."""
    spark = SparkSession.active()
    names, target = (config.features, config.target) if config else (None, None)
    manifest = spark.createDataFrame([(n, names, target) for n in sorted(models)], "segment string, features array<string>, target string").withColumn("folder", safe_name("segment"))
    for row in manifest.collect():
        models[row["segment"]].write().overwrite().save(f"{path}/{row['folder']}")
    manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    return manifest


def segments(manifest: DataFrame) -> DataFrame:
    return manifest.select("segment").distinct().orderBy("segment")


def load(spark, path: str) -> dict[str, PipelineModel]:
    return {r["segment"]: PipelineModel.load(f"{path}/{r['folder']}") for r in spark.read.parquet(f"{path}/manifest").collect()}


def checklist(df: DataFrame, expected: list[str], encodings: list[str]) -> DataFrame:
    """(check, passed, detail): columns present, rows there, no NaN or null, encodings positive."""
    lacking = [c for c in expected if c not in df.columns]
    have = [c for c in expected if c in df.columns]
    bad = F.lit(False)
    for c in have:
        bad = bad | F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double"))
    one = df.agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), *[F.min(e).alias(e) for e in encodings])
    checks = [F.struct(F.lit("columns").alias("check"), F.lit(not lacking).alias("passed"), F.lit(",".join(lacking)).alias("detail")), F.struct(F.lit("rows").alias("check"), (F.col("n") > 0).alias("passed"), F.col("n").cast("string").alias("detail")), F.struct(F.lit("complete").alias("check"), (F.col("bad") == 0).alias("passed"), F.col("bad").cast("string").alias("detail"))]
    checks += [F.struct(F.lit(f"{e} positive").alias("check"), F.coalesce(F.col(e) > 0, F.lit(False)).alias("passed"), F.lit("").alias("detail")) for e in encodings]
    return one.select(F.explode(F.array(*checks)).alias("_c")).select("_c.*")
