"""The outlier filter and the feature chain as Spark ML stages: with a model they are one pipeline that is fitted, kept and loaded whole.

Rows with the target are rows to learn from or to judge by: the stages leave out what is an outlier
or incomplete.  Rows without it are rows to score: the stages leave out none, and derive what
is missing.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.operators import outliers, rows
from wattlake.plans import features
from wattlake.session import forget, stash


class _Writer(MLWriter):
    """Parameters as Spark ML keeps them, and what was learned as Parquet beside them."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance._save_learned(f"{path}/learned")


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.kind()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        instance._load_learned(self.sparkSession, f"{path}/learned")
        return instance


class _Kept(MLReadable, MLWritable):
    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Filtering(Params):
    segmentCol = Param(Params._dummy(), "segmentCol", "column of the segments, each of which has limits of its own", TypeConverters.toString)
    targetCol = Param(Params._dummy(), "targetCol", "column whose outliers go", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "JSON of outliers.Settings", TypeConverters.toString)

    def _given(self, segment: str, target: str, settings: outliers.Settings):
        self._set(segmentCol=segment, targetCol=target, settings=json.dumps(asdict(settings)))


class OutlierFilter(Estimator, _Filtering, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the limits of :func:`outliers.thresholds`."""

    def __init__(self, segment: str = "machine_type", target: str = features.TARGET, settings: outliers.Settings = outliers.Settings(), overrides: DataFrame | None = None):
        super().__init__()
        self._given(segment, target, settings)
        self.overrides = overrides

    def _fit(self, dataset: DataFrame) -> OutlierFilterModel:
        segment, target = self.getOrDefault("segmentCol"), self.getOrDefault("targetCol")
        model = OutlierFilterModel(stash(outliers.thresholds(dataset, segment, target, outliers.Settings(**json.loads(self.getOrDefault("settings"))), self.overrides)))
        model._resetUid(self.uid)
        return self._copyValues(model)


class OutlierFilterModel(Model, _Filtering, _Kept):
    """Leaves out rows whose target is beyond its segment's limits; rows without a target column stay as they are."""

    def __init__(self, limits: DataFrame | None = None):
        super().__init__()
        self.limits = limits

    def _transform(self, dataset: DataFrame) -> DataFrame:
        segment, target = self.getOrDefault("segmentCol"), self.getOrDefault("targetCol")
        return outliers.filtered(dataset, self.limits, segment, target) if target in dataset.columns else dataset

    def _save_learned(self, path: str) -> None:
        rows.small_table(self.limits).write.parquet(path)

    def _load_learned(self, spark, path: str) -> None:
        self.limits = spark.read.parquet(path)


class _Featuring(Params):
    keyCols = Param(Params._dummy(), "keyCols", "columns that are handed on as they are", TypeConverters.toListString)
    inputs = Param(Params._dummy(), "inputs", "feature columns that the model gets; all if none is named", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "the vector of the inputs", TypeConverters.toString)


class FeatureChain(Estimator, _Featuring, DefaultParamsReadable, DefaultParamsWritable):
    """Learns :func:`features.fit` from rows with the target."""

    settings = Param(Params._dummy(), "settings", "JSON of features.Settings", TypeConverters.toString)

    def __init__(self, keys: tuple[str, ...] = (), settings: features.Settings = features.Settings(), inputs: tuple[str, ...] = (), output: str = "_features", reference: DataFrame | None = None):
        super().__init__()
        self._set(keyCols=list(keys), inputs=list(inputs), outputCol=output, settings=json.dumps(asdict(settings)))
        self.reference = reference

    def _fit(self, dataset: DataFrame) -> FeatureChainModel:
        given = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(self.getOrDefault("settings")).items()}
        model = FeatureChainModel(features.fit(dataset, features.Settings(**given)), self.reference)
        model._resetUid(self.uid)
        return self._copyValues(model)


class FeatureChainModel(Model, _Featuring, _Kept):
    """The keys, the target if it's there, and the fitted columns as one vector (NaN where a value lacks).

    Rows with the target are prepared as in training.  Rows without it get what :func:`features.derived`
    gives them; *reference* (latitude, longitude, grupo_regional) is kept with the model, for
    rows that have no group.
    """

    def __init__(self, fitted: features.Fitted | None = None, reference: DataFrame | None = None):
        super().__init__()
        self.fitted, self.reference = fitted, reference

    def table(self, dataset: DataFrame) -> DataFrame:
        """The fitted columns by their names, beside the keys and the target if it's there."""
        keys, target = list(self.getOrDefault("keyCols")), self.fitted.settings.target
        if target in dataset.columns:
            held = dataset.withColumn("_target", F.col(target).cast("double"))
            return features.apply(features.prepared(held, self.fitted.settings), self.fitted, [*keys, "_target"]).withColumnRenamed("_target", target)
        return features.scored(dataset, self.fitted, self.reference, keys)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        table, target = self.table(dataset), self.fitted.settings.target
        names = self.getOrDefault("inputs") or self.fitted.columns
        values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in names]
        had = [target] if target in table.columns else []
        return table.select(*self.getOrDefault("keyCols"), *had, array_to_vector(F.array(*values)).alias(self.getOrDefault("outputCol")))

    def _save_learned(self, path: str) -> None:
        features.save(self.fitted, f"{path}/fitted")
        if self.reference is not None:
            rows.small_table(self.reference.select("latitude", "longitude", "grupo_regional")).write.parquet(f"{path}/reference")

    def _load_learned(self, spark, path: str) -> None:
        self.fitted = features.load(spark, f"{path}/fitted")
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/reference")
        there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
        self.reference = spark.read.parquet(f"{path}/reference") if there else None


def release(model) -> None:
    """Deletes what a fitted stage has in the shared folder, once it is kept elsewhere or no longer needed."""
    if isinstance(model, OutlierFilterModel):
        forget(model.limits)
    elif isinstance(model, FeatureChainModel):
        forget(model.fitted.encodings, model.fitted.indices, model.fitted.limits)
