"""Pipelines from raw rows, many segments at once, trees as tables, and the search against a plain loop."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wattlake.operators import gram, outliers
from wattlake.operators.metrics import error_metrics
from wattlake.operators.sampling import bucket
from wattlake.plans import features, raw, stages, training, trees
from wattlake.sources import tables

RAW = "row_key long, hora int, data date, consumo_kwh double, machine_type string, estacao string, grupo_regional int, " + ", ".join(f"`{m}` double" for m in features.MEASURED)


def observed(spark, n, first=0, types=("splitao", "SPLITAO", "Cassete", " ")):
    """*n* raw rows whose consumption follows the hour; every 50th far beyond, every 40th without its first measure."""
    rows = []
    for i in range(first, first + n):
        measures = [None if i % 40 == 0 and not k else float((i * 7 + k) % 50) for k in range(len(features.MEASURED))]
        rows.append((i, i % 24, dt.date(2025, 4, 18) + dt.timedelta(days=i % 9), 1e6 if i % 50 == 0 else 5.0 + i % 24 + i % 3 / 10, types[i % len(types)], "outono", i % 2, *measures))
    return spark.createDataFrame(rows, RAW)


def test_raw_rows_to_predictions_and_back_from_disk(spark, tmp_path):
    df = observed(spark, 600)
    config = training.Config(features=None, key="row_key", models=["linear", "tree"])
    report, models = raw.compare(df, raw.Settings(config))
    assert {r["model"]: r["n_train"] + r["n_test"] for r in report.collect()} == dict.fromkeys(("linear", "tree"), 600 - 12 - 15 + 3)  # outliers and incomplete rows, some both
    models["linear"].write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert [type(s) for s in again.stages[:2]] == [stages.OutlierFilterModel, stages.FeatureChainModel]
    new = observed(spark.newSession(), 100, 1000).drop("estacao")
    want = {r["row_key"]: r["prediction"] for r in raw.scored(new, models["linear"]).collect()}
    got = {r["row_key"]: r["prediction"] for r in raw.scored(new.drop("consumo_kwh"), again).collect()}
    assert got == pytest.approx(want, nan_ok=True) and len(got) == 100  # outliers among rows to score stay, and so do incomplete ones
    limits = {r["machine_type"]: r["hi"] for r in again.stages[0].limits.collect()}
    assert set(limits) == {"splitao", "SPLITAO", "Cassete", "DESCONHECIDO"} and max(limits.values()) < 1e6
    assert again.stages[1].table(new.drop("consumo_kwh")).columns == ["row_key", *again.stages[1].fitted.columns]


def test_stages_in_a_pipeline_of_ones_own(spark, tmp_path):
    """The estimators themselves are kept and loaded, too; their settings survive."""
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression

    limits = outliers.Settings(iqr_factor=1.0, upper_quantile_cap=0.95)
    own = Pipeline(stages=[stages.OutlierFilter(settings=limits), stages.FeatureChain(("row_key",), inputs=("hora_target_enc",)), LinearRegression(featuresCol="_features", labelCol="consumo_kwh")])
    own.write().save(str(tmp_path / "p"))
    again = Pipeline.load(str(tmp_path / "p"))
    df = observed(spark, 300)
    a, b = own.fit(df), again.fit(df)
    assert a.stages[2].coefficients.toArray() == pytest.approx(b.stages[2].coefficients.toArray()) and a.stages[2].numFeatures == 1
    assert {r["iqr_factor_used"] for r in b.stages[0].limits.collect()} <= {1.0}
    reference = spark.createDataFrame([(-10.0, -40.0, 1), (50.0, 50.0, 0)], "latitude double, longitude double, grupo_regional int")
    chain = stages.FeatureChain(("row_key",), reference=reference).fit(df.filter("consumo_kwh < 100"))
    chain.write().save(str(tmp_path / "c"))
    placed = df.drop("consumo_kwh", "grupo_regional").withColumn("latitude", F.lit(49.0)).withColumn("longitude", F.lit(49.0))
    table = stages.FeatureChainModel.load(str(tmp_path / "c")).table(placed)
    assert table.count() == 300 and table.filter("grupo_regional <> 0").count() == 0


def test_segments_from_raw_rows(spark):
    df = observed(spark, 600).unionByName(observed(spark, 9, 5000, ("rooftop",)))
    models, report = raw.fit_segments(df, raw.Settings(training.Config(features=None, key="row_key", models=["linear"])))
    found = {r["segment"]: r for r in report.collect()}
    assert len(models) == 3 and "SPLITÃO" in models  # two spellings are one type
    assert sum(r["skipped"] == "9 rows" for r in found.values()) == 1
    scored = raw.scored_by_segment(observed(spark, 100, 900).drop("consumo_kwh"), models)
    assert scored.count() == 100 and scored.select("tipo_maquina").distinct().count() == 3
    with pytest.raises(ValueError):
        raw.scored_by_segment(df, models)
    with pytest.raises(ValueError):
        raw.compare(observed(spark, 1), raw.Settings(training.Config(features=None, key="row_key")))  # its only row is incomplete


def test_a_thousand_segments_in_one_look(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(50, 3, (20_000, 3))
    x[:, 2] = 2 * x[:, 0] - 7  # depends on another
    part = rng.integers(0, 1000, len(x))
    y = 1000 + x[:, 0] * part - 3 * x[:, 1] + rng.normal(size=len(x))
    rows = [(int(s), *map(float, v), float(t)) for s, v, t in zip(part, x, y, strict=True)] + [(5, None, 1.0, 1.0, 1.0), (5, math.nan, 1.0, 1.0, 1.0), (5, 1.0, 1.0, 1.0, None), (None, 1.0, 2.0, -5.0, 3.0)]
    df = spark.createDataFrame(rows, "s int, a double, b double, c double, y double")
    found = gram.lines(df, ["a", "b", "c"], "y", "s")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    lines = {r["segment"]: r for r in found.collect()}
    assert len(lines) == len(set(part)) + 1 and lines[None]["n"] == 1 and lines[None]["intercept"] == 3.0
    for s in range(0, 1000, 37):
        own = part == s
        design = np.column_stack([np.ones(own.sum()), x[own, :2]])
        want = design @ np.linalg.lstsq(design, y[own], rcond=None)[0]
        r = lines[str(s)]
        assert r["n"] == own.sum() and np.allclose(r["intercept"] + x[own] @ np.array(r["coefficients"]), want, atol=1e-5)


def test_lines_take_no_call_a_segment(spark):
    """Few columns are summed by Spark's own aggregates and segments solved in batches; many columns, from matrix products, have the same lines."""
    rng = np.random.default_rng(6)
    rows = [(int(s), *map(float, v)) for s, v in zip(rng.integers(0, 300, 3000), rng.normal(1e5, 2, (3000, 3)), strict=True)] + [(300, 1.0, 1.0, 4.0), (None, 1.0, math.nan, 4.0)]
    df = spark.createDataFrame(rows, "s int, a double, b double, y double").repartition(3)
    found = gram.lines(df, ["a", "b"], "y", "s")
    assert "InPandas" not in found._jdf.queryExecution().executedPlan().toString()
    got = {r["segment"]: r for r in found.collect()}
    narrow, gram.NARROW = gram.NARROW, 0
    try:
        want = {r["segment"]: r for r in gram.lines(df, ["a", "b"], "y", "s").collect()}
    finally:
        gram.NARROW = narrow
    assert set(got) == set(want) and got["300"]["intercept"] == 4.0 and None not in got
    for s, r in want.items():
        assert got[s]["n"] == r["n"] and np.allclose(got[s]["coefficients"], r["coefficients"], atol=1e-6)
        assert got[s]["intercept"] + sum(got[s]["coefficients"]) * 1e5 == pytest.approx(r["intercept"] + sum(r["coefficients"]) * 1e5, rel=1e-9)
    assert gram.lines(df, ["a", "b"], "y").first()["n"] == 3001


def test_moments_of_many_columns(spark):
    """200 columns with gaps, in a plan that doesn't grow with them, and handed on in pieces: r as numpy has it."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 200)) + 1e6
    x[:, 1] = 5.0
    x[rng.random(x.shape) < 0.05] = np.nan
    columns = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(None if i % 2 and math.isnan(v) else v for i, v in enumerate(row)) for row in x.tolist()], ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = {(r["a"], r["b"]): (r["n"], r["r"]) for r in gram.correlations(df, columns).collect()}
    assert len(got) == 200 * 199 // 2 and got["c0", "c1"][1] is None
    for i, j in random.Random(3).sample([(i, j) for i in range(2, 200) for j in range(i + 1, 200)], 300):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        n, r = got[f"c{i}", f"c{j}"]
        assert n == both.sum() and abs(r - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
    plans = [len(gram.correlations(df.select(columns[:k]), columns[:k])._jdf.queryExecution().logical().toString().split("\n")) for k in (5, 200)]
    assert plans[0] == plans[1]
    held, gram.HELD = gram.HELD, 100
    try:
        few = {(r["segment"], r["i"]): r for r in gram.moments(df.withColumn("s", F.col("c0") > 1e6), columns[:3], "s").collect()}
        assert sum(r["n"][2] for r in few.values() if r["i"] == 2) == (~np.isnan(x[:, 2])).sum()
    finally:
        gram.HELD = held


def examples(spark):
    rng = random.Random(4)
    return spark.createDataFrame([(i, rng.choice("abc"), rng.random(), None if i % 17 == 0 else rng.random(), 0.0) for i in range(900)], "row_key long, tipo_maquina string, x double, z double, consumo_kwh double").withColumn("consumo_kwh", F.col("x") * 3 + F.when(F.col("z") > 0.4, 7).otherwise(2) + F.ascii("tipo_maquina"))


CONFIG = training.Config(features=["x", "z"], models=["linear"], params={"forest": {"numTrees": 4, "maxDepth": 4, "seed": 1}, "gbt": {"maxIter": 3, "maxDepth": 3, "seed": 1}, "tree": {"maxDepth": 4}})


@pytest.mark.parametrize("most", [trees.MOST_NODES, 10])
def test_trees_as_a_table(spark, most):
    """A tree, a forest and boosting, each of its segment, score as their models do; also in lots of segments."""
    df = examples(spark)
    models = {s: training.fit(df.filter(F.col("tipo_maquina") == s).na.fill(0.0), CONFIG, name) for s, name in zip("abc", ["tree", "forest", "gbt"], strict=True)}
    table = trees.nodes({s: m.stages[-1] for s, m in models.items()})
    more = df.unionByName(df.limit(3).withColumn("tipo_maquina", F.lit("none"))).unionByName(df.limit(2).withColumn("tipo_maquina", F.lit(None).cast("string")))
    got = {(r["tipo_maquina"], r["row_key"]): r["prediction"] for r in trees.scored(more, table, "tipo_maquina", [F.col("x"), F.col("z")], most=most).collect()}
    for s, m in models.items():
        for r in m.transform(df.filter(F.col("tipo_maquina") == s)).collect():
            assert got[s, r["row_key"]] == pytest.approx(r["prediction"], abs=1e-9)
    assert len(got) == 905 and all(v is None for (s, _), v in got.items() if s not in models)


def test_one_look_scores_all_segments(spark, tmp_path):
    df = examples(spark)
    df.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    kinds = dict(zip("abc", ["linear", "forest", "gbt"], strict=True))
    models = {s: training.fit(df.filter(F.col("tipo_maquina") == s).na.fill(0.0), CONFIG, name) for s, name in kinds.items()}
    scored = training.predict_segments(df.na.fill(0.0), models, CONFIG)
    assert scored._jdf.queryExecution().executedPlan().toString().count("/rows]") == 1  # one scan of the rows
    got = {r["row_key"]: r["prediction"] for r in scored.collect()}
    for s, m in models.items():
        for r in m.transform(df.filter(F.col("tipo_maquina") == s).na.fill(0.0)).collect():
            assert got[r["row_key"]] == pytest.approx(r["prediction"], abs=1e-9)
    placed = training.predict_segments(df.na.fill(0.0), models, CONFIG, [F.desc("row_key")]).collect()
    assert [r["row_number"] for r in placed] == list(range(900)) and [r["row_key"] for r in placed] == list(range(899, -1, -1))


def test_segments_are_fitted_on_rows_kept_once(spark, tmp_path, monkeypatch):
    """No segment's fits read the input anew; the one copy that they are taken from has it."""
    examples(spark).na.fill(0.0).write.parquet(str(tmp_path / "rows"))
    seen, real = [], training.compare
    monkeypatch.setattr(training, "compare", lambda rows, config: (seen.append(tables.roots(rows)), real(rows, config))[1])
    models, _ = training.fit_segments(spark.read.parquet(str(tmp_path / "rows")), CONFIG)
    assert sorted(models) == ["a", "b", "c"] and len({tuple(r) for r in seen}) == 1 and "stash-" in seen[0][0]


@pytest.mark.parametrize("name", ["tree", "linear"])
def test_search_finds_what_a_loop_finds(spark, name):
    df = examples(spark).na.fill(0.0)
    config = training.Config(features=["x", "z"], draws=3)
    _, best, error = training.tune(df, config, name)
    rows, errors = df.withColumn("_fold", F.pmod(bucket("row_key", config.seed + 1), F.lit(config.folds))), []
    for params in training.draws(training.GRIDS[name], config.draws, config.seed):
        each = [error_metrics(training.fit(rows.filter(F.col("_fold") != k), config, name, params).transform(rows.filter(F.col("_fold") == k)), "consumo_kwh", "prediction").first()["MAPE"] for k in range(config.folds)]
        errors.append((sum(each) / len(each), params))
    assert (error, best) == (pytest.approx(min(errors, key=lambda e: e[0])[0]), min(errors, key=lambda e: e[0])[1])


def test_lines_of_all_segments(spark):
    config = training.Config(features=["x", "z"], models=["linear"], least_rows=50)
    df = examples(spark).na.fill(0.0).unionByName(examples(spark).limit(3).withColumn("tipo_maquina", F.lit(" ")))
    lines, report = training.line_models(df, config)
    old, want = training.fit_segments(df, config)
    rows = {r["segment"]: r for r in report.collect()}
    assert set(rows) == {"a", "b", "c", "DESCONHECIDO"} and rows["DESCONHECIDO"]["skipped"] == "3 rows" and rows["a"]["skipped"] is None
    for r in want.filter("model is not null").collect():
        assert [rows[r["segment"]][k] for k in ("n_train", "n_test")] == [r["n_train"], r["n_test"]] and rows[r["segment"]]["MAPE"] == pytest.approx(r["MAPE"])
    assert training.line_scores(df, lines, config).filter("prediction is null").count() == 3
