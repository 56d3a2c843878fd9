import datetime as dt

import pytest

from wattlake.plans import enrich, training
from wattlake.sources import tables, weather


@pytest.mark.parametrize("sep", [";", ",", "\t", "|"])
def test_csv_separator(spark, tmp_path, sep):
    path = tmp_path / "u.csv"
    path.write_text(sep.join(["id", "unit_name", "n"]) + "\n" + sep.join(["1", '"Loja, Centro"', "2"]) + "\n")
    assert tables.separator_of(spark, str(path)) == sep
    assert tables.read_csv(spark, str(path)).first()["unit_name"] == "Loja, Centro"
    assert tables.read_csv(spark, str(path), "id int, unit_name string, n int", columns=["n"]).columns == ["n"]


def test_parquet(spark, tmp_path):
    a = str(tmp_path / "a")
    tables.write_parquet(spark.range(3), a)
    with pytest.raises(ValueError):
        tables.write_parquet(tables.read_parquet(spark, a), a)
    assert tables.is_fresh(spark, a) and tables.extent(spark.range(3), "id").first()["n_rows"] == 3
    assert tables.read_source(spark, "parquet", a).count() == 3
    tables.write_csv(spark.range(3), str(tmp_path / "c"), ";")
    assert tables.read_csv(spark, str(tmp_path / "c")).count() == 3
    tables.write_report(spark.createDataFrame([("m", 1.5)], "model string, mae double"), str(tmp_path / "r"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "r")).select("model", "mae").collect()] == [("m", 1.5)]
    quoted = tmp_path / "q.csv"
    quoted.write_text('id;"a,b,c,d";n\n1;x;2\n')
    assert tables.separator_of(spark, str(quoted)) == ";"
    with pytest.raises(ValueError):
        tables.read_source(spark, 9, "x")


def test_append(spark):
    old, new = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "z"), (2, "b"), (2, "b")], "k int, v string")
    assert sorted(tuple(r) for r in tables.append_version(new, old, ["k"]).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        tables.append_version(new.withColumnRenamed("v", "w"), old, ["k"])


def test_weather(spark):
    hours = ",".join(f'"2024-01-01T{h:02d}:00"' for h in (0, 23))
    body = '{"hourly":{"time":[' + hours + "]," + ",".join(f'"{m}":[{i},null]' for i, m in enumerate(weather.MEASURES)) + "}}"
    parsed = weather.parse_responses(spark.createDataFrame([(1.0, 2.0, body), (3.0, 4.0, "{}")], "latitude double, longitude double, body string"))
    got = parsed.collect()
    assert [r["hora"] for r in got] == [0, 23] and got[0]["Umidade_Relativa_%"] == 2.0 and got[1]["Temperatura_C"] is None
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 0, 1.0, 2.0), (dt.date(2024, 1, 2), 0, 1.0, 2.0), (dt.date(2024, 1, 2), 0, None, 2.0)], "data date, hora long, latitude double, longitude double")
    assert sorted(r["Temperatura_C"] is None for r in enrich.with_weather(rows, parsed).collect()) == [False, True, True]
    assert [r["data_str"] for r in enrich.weather_work(rows, parsed).collect()] == ["2024-01-02"]
    assert weather.extended(parsed, parsed).count() == 2


def test_models(spark, tmp_path):
    rows = [(i, "A" if i % 2 else "b", float(i % 7), 2.0 * (i % 7) + 1) for i in range(200)] + [(900, " ", 1.0, 3.0)]
    df = spark.createDataFrame(rows, "row_key long, tipo_maquina string, x double, consumo_kwh double")
    config = training.Config(features=["x"], models=["linear"])
    models, report = training.fit_segments(df, config)
    assert set(models) == {"A", "b"} and {r["segment"] for r in report.filter("skipped is not null").collect()} == {"DESCONHECIDO"}
    assert training.consolidated_report(report).first()["MAE"] < 0.01
    scored = training.predict_segments(df.filter("row_key < 900"), models, config)
    assert scored.count() == 200 and abs(scored.filter("row_key = 5").first()["prediction"] - 11) < 0.01
    with pytest.raises(ValueError):
        training.predict_segments(df, models, config)
    manifest = training.save(models, str(tmp_path / "m"), config)
    assert {tuple(r["features"]) for r in spark.read.parquet(str(tmp_path / "m" / "manifest")).collect()} == {("x",)}
    assert [r[0] for r in training.segments(manifest).collect()] == ["A", "b"] and set(training.load(spark, str(tmp_path / "m"))) == {"A", "b"}
    assert training.draws({"a": [1, 2], "b": [1, 2]}, 3, 1) == training.draws({"a": [1, 2], "b": [1, 2]}, 3, 1)
    checks = {r["check"]: r["passed"] for r in training.checklist(df, ["x", "nope"], ["x"]).collect()}
    assert checks["columns"] is False and checks["rows"] is True and checks["x positive"] is False
