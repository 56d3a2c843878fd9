"""The feature chain: fitted, kept, read again and applied to other rows."""

import datetime as dt

import pytest

from wattlake.plans import features

FIELDS = "row_key long, hora int, data date, consumo_kwh double, machine_type string, estacao string, grupo_regional int, " + ", ".join(f"`{m}` double" for m in features.MEASURED)


def observed(spark, n, first=0, lacking=None):
    """*n* rows; *lacking* is the first measure of all of them, if it is to be null."""
    day = dt.date(2025, 4, 18)
    measures = lambda i: [None if lacking and not k else float((i * 7 + k) % 50) for k in range(len(features.MEASURED))]
    return spark.createDataFrame([(i, i % 24, day + dt.timedelta(days=i % 9), 1.0 + i % 24, ["splitao", "Cassete", " "][i % 3], "outono", i % 2, *measures(i)) for i in range(first, first + n)], FIELDS)


def test_what_is_kept_gives_the_same_features(spark, tmp_path):
    train = observed(spark, 300)
    fitted = features.fit(train)
    features.save(fitted, str(tmp_path / "fitted"))
    again = features.load(spark, str(tmp_path / "fitted"))
    assert (again.columns, again.vocabularies, again.settings) == (fitted.columns, fitted.vocabularies, fitted.settings)
    ready = features.prepared(train)
    want = sorted(features.apply(ready, fitted, ["row_key"]).collect())
    assert sorted(features.apply(ready, again, ["row_key"]).collect()) == want and len(want) == 300
    assert set(features.apply(ready, fitted).columns) == set(fitted.columns) and all(0 <= r["Temperatura_C"] <= 1 for r in want)


def test_calendar_columns(spark):
    got = {r["row_key"]: r for r in features.with_dates(observed(spark, 9)).collect()}
    assert "data" not in got[0].asDict() and (got[0]["is_feriado"], got[0]["is_dia_util"], got[0]["periodo_dia"]) == (1, 0, "Madrugada")  # Good Friday
    assert got[2]["is_vespera_feriado"] == 1 and got[3]["is_feriado"] == 1 and got[4]["is_dia_util"] == 1


def test_rows_with_unseen_values_and_without_groups_are_scored(spark):
    fitted = features.fit(observed(spark, 300))
    new = spark.createDataFrame([(1, 5, dt.date(2025, 7, 1), "never seen", -10.0, -40.0), (2, 30, dt.date(2025, 4, 1), None, None, None)], "row_key long, hora int, data date, tipo_maquina string, latitude double, longitude double")
    reference = spark.createDataFrame([(-10.0, -40.1, 1), (50.0, 50.0, 0)], "latitude double, longitude double, grupo_regional int")
    got = {r["row_key"]: r for r in features.scored(new, fitted, reference, ["row_key"]).collect()}
    means = {r["column"]: r["global_mean"] for r in fitted.encodings.collect()}
    assert got[1]["tipo_maquina_SPLITÃO"] == got[1]["Temperatura_C"] == 0.0 and got[1]["grupo_regional"] == 1.0 and got[2]["grupo_regional"] == -1.0
    assert abs(got[2]["hora_target_enc"] - means["hora"]) < 1e-4 and abs(got[1]["mes_target_enc"] - means["mes"]) < 1e-4
    dense = {r["row_key"]: r for r in features.dense_inputs(new, fitted, {"hora": 24, "mes": 13, "grupo_regional": 2, "periodo_dia": 4}, reference, ["row_key"]).collect()}
    assert dense[1]["valid"] and not dense[2]["valid"] and dense[2]["grupo_regional"] is None and len(dense[1]["dense"]) == len(dense[2]["dense"])
    with pytest.raises(ValueError):
        features.derived(new.drop("latitude"), reference)
    with pytest.raises(ValueError):
        features.derived(new)
    with pytest.raises(ValueError):
        features.fit(observed(spark, 5).drop("estacao"))


def test_incomplete_rows_are_left_out(spark):
    df = observed(spark, 40).unionByName(observed(spark, 3, 100, lacking=True))
    assert features.prepared(df).count() == 40 and "tipo_maquina_SPLITÃO" in features.built(df).columns
