"""Training and scoring from raw rows: filter, features and model in one call, kept as one pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.functions.machines import UNKNOWN, machine_type
from wattlake.functions.scalars import label_or
from wattlake.operators import outliers
from wattlake.plans import features, stages, training
from wattlake.session import forget, stash


@dataclass
class Settings:
    """How raw rows become inputs.  *model* says what is fitted; its features are *inputs*, all fitted columns if none is named."""

    model: training.Config = field(default_factory=lambda: training.Config(features=None))
    outliers: outliers.Settings = outliers.Settings()
    overrides: DataFrame | None = None
    features: features.Settings = features.Settings()
    inputs: tuple[str, ...] = ()
    reference: DataFrame | None = None  # coordinates of groups, for rows to score that have none


def preparation(df: DataFrame, settings: Settings) -> PipelineModel:
    """The outlier filter and the feature chain, fitted on raw rows with the target."""
    s = settings
    chain = stages.FeatureChain((s.model.key,), s.features, s.inputs, reference=s.reference)
    return Pipeline(stages=[stages.OutlierFilter(target=s.model.target, settings=s.outliers, overrides=s.overrides), chain]).fit(df)


def compare(df: DataFrame, settings: Settings, search: bool = False) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """The report of :func:`training.compare` on raw rows, and each model as a pipeline that takes raw rows.

    Outliers go first and features are learned from what stays, once for all models; then rows
    are split by their key, fitted and judged.  No row left is an error.
    """
    config = replace(settings.model, features=None)
    prepared = preparation(df, settings)
    matrix = stash(prepared.transform(df))
    if matrix.isEmpty():
        raise ValueError("the outlier filter and the required fields leave no row to learn from")
    report, models = training.compare(matrix, config, search)
    forget(matrix)
    return report, {name: PipelineModel(stages=[*prepared.stages, *m.stages]) for name, m in models.items()}


def fit(df: DataFrame, settings: Settings, name: str, search: bool = False) -> tuple[PipelineModel, DataFrame]:
    """One model from raw rows to predictions, and its metrics on the test rows."""
    report, models = compare(df, replace(settings, model=replace(settings.model, models=[name])), search)
    return models[name], report


def by_type(df: DataFrame) -> DataFrame:
    """Adds ``_type``: the machine's type under its one name, by which segments are told apart."""
    return df.withColumn("_type", label_or(machine_type("machine_type"), UNKNOWN))


def fit_segments(df: DataFrame, settings: Settings, search: bool = False) -> tuple[dict[str, PipelineModel], DataFrame]:
    """The best pipeline of each type of machine, with limits and features of its own, and the report (a reason where one was left out).

    Spellings of a type are made one before rows are told apart.  Each type's rows are kept
    apart on disk, so a fit reads its own only.
    """
    rows = stash(by_type(df))
    best, reports, skipped = {}, [], []
    for r in rows.groupBy("_type").count().orderBy("_type").collect():
        name, n = r["_type"], r["count"]
        if n < settings.model.least_rows:
            skipped.append((name, f"{n} rows"))
            continue
        try:
            report, models = compare(rows.filter(F.col("_type") == name).drop("_type"), settings, search)
        except ValueError as e:
            skipped.append((name, str(e)))
            continue
        best[name] = models[report.filter("rank = 1").first()["model"]]
        reports.append(report.withColumn("segment", F.lit(name)))
    forget(rows)
    left_out = df.sparkSession.createDataFrame(skipped, "segment string, skipped string")
    if not reports:
        return best, left_out
    return best, reduce(DataFrame.unionByName, reports).join(left_out, "segment", "full")


def scored(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions (key, prediction) of raw rows, none left out: a target that they bring is not looked at."""
    target = model.stages[1].fitted.settings.target
    rows = df.drop(target)
    rows = rows if "machine_type" in rows.columns or "tipo_maquina" not in rows.columns else rows.withColumnRenamed("tipo_maquina", "machine_type")
    return model.transform(rows).select(*model.stages[1].getOrDefault("keyCols"), "prediction")


def scored_by_segment(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Predictions of raw rows, each by its type's pipeline; a type without one is an error.  One look a type: each has features of its own."""
    rows = by_type(df if "machine_type" in df.columns else df.withColumnRenamed("tipo_maquina", "machine_type"))
    unknown = rows.filter(~F.col("_type").isin(*models)).select("_type").distinct().limit(5).collect()
    if unknown:
        raise ValueError(f"no model for {[r[0] for r in unknown]}")
    parts = [scored(rows.filter(F.col("_type") == name), m).withColumn("tipo_maquina", F.lit(name)) for name, m in models.items()]
    return reduce(DataFrame.unionByName, parts)
