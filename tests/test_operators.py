import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.operators import associations, consolidate, encoders, geo, hourly, lags, metrics, outliers, profile, quantiles, rows, sampling


def payload(spark, *curr):
    return spark.createDataFrame([(f"D{i}", dt.date(2024, 1, 1), '{"Curr":"' + c + '"}') for i, c in enumerate(curr)], "dev_id string, day date, charts_detailed string")


def energy(spark, *curr):
    return {(r["device_id"], r["hora"]): r["consumo_kwh"] for r in hourly.hourly_energy(payload(spark, *curr)).collect()}


def test_apportionment(spark):
    got = energy(spark, "5*3600,2.5*1800,*60,3", "1*5400", "1*3600,1*0.5,2*3600", "1*90000", "abc*10,4*0,4*-5, 2 * 3600 ", "")
    kwh = lambda amps, s: round(310.94 * amps * s / 3600 / 1000, 6)
    assert got[("D0", 0)] == kwh(5, 3600) and got[("D0", 1)] == round(kwh(2.5, 1800) + kwh(3, 1), 6)
    assert got[("D1", 0)] == kwh(1, 3600) and got[("D1", 1)] == kwh(1, 1800)
    assert abs(got[("D2", 1)] - kwh(2, 3599.5)) < 2e-6  # the half second at the boundary vanishes
    assert {h for d, h in got if d == "D3"} == set(range(24))
    assert got[("D4", 0)] == kwh(2, 3600) and not any(d == "D5" for d, _ in got)


def test_apportionment_keeps_seconds(spark):
    got = energy(spark, ",".join(f"1*{s}" for s in (17, 3583, 7200, 301, 4000)))
    assert abs(sum(got.values()) - 310.94 * (17 + 3583 + 7200 + 301 + 4000) / 3.6e6) < 1e-5


def test_lags(spark):
    d = dt.date(2024, 1, 1)
    data = [(1, "a", d, 22, 1.0), (1, "a", d, 23, 2.0), (1, "a", d + dt.timedelta(1), 0, 4.0), (1, "a", d + dt.timedelta(1), 2, 8.0), (1, "a", d + dt.timedelta(1), 22, 3.0), (1, "a", d, 22, 3.0)]
    df = spark.createDataFrame(data, "unit_id long, machine_type string, data date, hora long, consumo_kwh double")
    got = {(str(r["data"]), r["hora"]): (r[4], r[5], r[6]) for r in lags.with_lags(df).collect()}
    assert got[("2024-01-01", 22)] == (None, None, 2.0)  # the mean of two rows of the hour
    assert got[("2024-01-02", 0)] == (2.0, None, round(8 / 3, 4))
    assert got[("2024-01-02", 2)][0] is None and got[("2024-01-02", 22)][1] == 2.0
    assert lags.add_lags(df).count() == len(data)


def test_quantiles(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 12)] + [("a", None), ("b", 5.0)], "g string, v double")
    got = {r["g"]: (r["n"], r["q"], r["m"]) for r in quantiles.nearest(df, "v", {"q": 0.25, "m": 0.5}, ["g"]).collect()}
    assert got == {"a": (11, 4.0, 6.0), "b": (1, 5.0, 5.0)}
    assert quantiles.linear(df, "v", {"m": 0.5}).first()["m"] == 5.5


def test_outliers(spark):
    small = [("tiny", float(i)) for i in range(5)]
    heavy = [("SPLITÃO", 1.0 + i / 100) for i in range(100)] + [("SPLITÃO", 1000.0)] * 3
    df = spark.createDataFrame(small + heavy, "seg string, v double")
    s = outliers.Settings(noise_floor=0.5, iqr_factor=1.5, min_segment_size=20, upper_quantile_cap=0.90)
    got = {r["seg"]: r for r in outliers.thresholds(df, "seg", "v", s).collect()}
    assert got["tiny"]["fallback_global_floor"] and got["tiny"]["noise_floor"] == 0.5 and got["tiny"]["lo"] <= got["tiny"]["hi"]
    assert got["SPLITÃO"]["hi"] < 1000 and got["SPLITÃO"]["tail_ratio"] > 1.5 and got["SPLITÃO"]["iqr_factor_used"] == 1.25
    override = spark.createDataFrame([("splitão", 3.0)], "segment string, iqr_factor double")
    changed = {r["seg"]: r for r in outliers.thresholds(df, "seg", "v", s, override).collect()}["SPLITÃO"]
    assert changed["manual_override"] and changed["iqr_factor_used"] == 3.0
    limits = outliers.thresholds(df, "seg", "v", s)
    kept = outliers.filtered(df, limits, "seg", "v")
    account = {r["seg"]: r for r in outliers.accounting(df, limits, "seg", "v").collect()}
    assert sum(r["n_after"] for r in account.values()) == kept.count()
    assert all(r["n_noise"] + r["n_extreme"] + r["n_after"] == r["n_before"] for r in account.values())
    assert outliers.impact(df, df.filter("seg = 'tiny'"), "seg").first()["seg"] == "SPLITÃO"


def test_rows_stay_where_they_are_beside_limits(spark, tmp_path):
    """The limits are a few rows of known size: no plan of a pass over the rows sorts or moves them by segment."""
    spark.range(2000).select(F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, " ").alias("seg"), F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    limits = outliers.thresholds(df, "seg", "v")
    passes = [outliers.filtered(df, limits, "seg", "v"), outliers.accounting(df, limits, "seg", "v"), outliers.impact(df, outliers.filtered(df, limits, "seg", "v"), "seg")]
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in passes[:2]):
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    assert passes[2].agg(F.sum("n_before")).first()[0] == 2000


def test_outliers_without_a_segment_stay(spark):
    rows = [("A", float(i)) for i in range(200)] + [(None, float(i)) for i in range(60)] + [(" ", float(i)) for i in range(60, 100)] + [("A", None)]
    df = spark.createDataFrame(rows, "seg string, v double")
    limits = outliers.thresholds(df, "seg", "v", outliers.Settings(noise_floor=0.0))
    assert {r["seg"]: r["n_before"] for r in limits.collect()} == {"A": 200, "DESCONHECIDO": 100}
    account = outliers.accounting(df, limits, "seg", "v")
    assert outliers.filtered(df, limits, "seg", "v").count() == sum(r["n_after"] for r in account.collect()) > 250
    total = outliers.totals(account).first()
    assert total["n_before"] == 300 and total["n_removed"] == total["n_noise"] + total["n_extreme"]
    assert outliers.totals(account.filter("false")).first()["pct_removed"] == 0.0
    assert all(r["pct"] < 20 for r in outliers.impact(df.filter("v is not null"), outliers.filtered(df, limits, "seg", "v"), "seg").collect())


def test_outlier_overrides_are_bounded(spark):
    df = spark.createDataFrame([("a-b", float(i)) for i in range(1, 101)], "seg string, v double")
    schema = "segment string, noise_floor double, iqr_factor double, min_segment_size double, noise_quantile double, upper_quantile_cap double, no_upper_cap boolean"
    one = lambda *o: outliers.thresholds(df, "seg", "v", outliers.Settings(upper_quantile_cap=0.95), spark.createDataFrame([("A B", *o)], schema)).first()
    r = one(-3.0, 0.0, 0.2, 0.9, 0.5, None)
    assert (r["iqr_factor_used"], r["min_segment_size_used"], r["noise_quantile_used"], r["upper_quantile_cap_used"]) == (0.1, 1, 0.25, 0.90) and r["noise_floor"] == 26.0
    r = one(None, None, None, None, None, True)
    assert r["upper_quantile_cap_used"] is None and r["hi_qcap"] is None and r["hi"] == r["hi_iqr"] and r["manual_override"]


@pytest.mark.parametrize("least", [1, 2, 4, 9])
def test_clusters_are_those_of_all_pairs(spark, least):
    """Dense places, chains, border points, the date line and a pole, against every pair in plain Python."""
    rng = random.Random(least)
    pts = [(rng.gauss(0, 0.1), rng.gauss(179.95, 0.1)) for _ in range(70)] + [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(120)] + [(10 + i * 0.2, 20.0) for i in range(12)]
    pts += [(90 - rng.random() / 5, rng.uniform(-180, 180)) for _ in range(25)] + [(5 + 0.01 * i, 5.0) for i in range(6)] + [(5 + 0.3, 5.0), (5 + 0.41, 5.0)]
    pts = sorted({(a, b - 360 if b > 180 else b) for a, b in pts})

    def km(a, b):
        p, q = math.radians(a[0]), math.radians(b[0])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371 * math.asin(min(1, math.sqrt(h)))

    near = {p: [q for q in pts if km(p, q) <= 40] for p in pts}
    core = {p for p in pts if len(near[p]) >= least}
    root = {}
    for p in sorted(core):
        todo = [p] if p not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = p
                todo += [q for q in near[x] if q in core]
    for p in pts:
        if p not in core and any(q in core for q in near[p]):
            root[p] = min(root[q] for q in near[p] if q in core)
    order = [(0, r) for r in sorted(set(root.values()))] + [(1, p) for p in pts if p not in root]
    number = {r: i for i, (_, r) in enumerate(order)}
    want = {p: (number[root.get(p, p)], p in core) for p in pts}
    got = geo.clusters(spark.createDataFrame(pts, "latitude double, longitude double"), 40.0, least).collect()
    assert {(r["latitude"], r["longitude"]): (r["grupo_regional"], r["is_core"]) for r in got} == want


def test_nearest_group(spark):
    rng = random.Random(4)
    ref = [(rng.uniform(-90, 90), rng.uniform(-180, 180), i) for i in range(300)] + [(10 + rng.random() / 100, 179.99 + rng.random() / 50 - 0.01, 300 + i) for i in range(300)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)] + [(90.0, 0.0), (-90.0, 5.0), (10.0, -179.999), (0.0, 180.0), (None, 1.0), ref[3][:2]]
    got = geo.assign(spark.createDataFrame(points, "latitude double, longitude double"), spark.createDataFrame(ref, "latitude double, longitude double, grupo_regional int"))

    def km(a, b):
        p, q = math.radians(a[0]), math.radians(b[0])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return round(2 * 6371 * math.asin(min(1, math.sqrt(h))), 9)

    for r in got.collect():
        here = (r["latitude"], r["longitude"])
        want = None if None in here else min((km(here, x), *x) for x in ref)[-1]
        assert r["grupo_regional"] == want


def test_mapping_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.1), (50.0, 2.0)], "latitude double, longitude double")
    made = geo.clusters(df, 40.0, 2)
    geo.save_mapping(made, str(tmp_path / "groups"))
    again = geo.load_mapping(spark, str(tmp_path / "groups"))
    assert sorted(again.collect()) == sorted(made.drop("is_core").collect()) and again.columns == ["latitude", "longitude", "grupo_regional"]
    assert {r["longitude"]: r["grupo_regional"] for r in geo.assign(df, again).collect() if r["latitude"] == 1.0} == {2.0: 0, 2.1: 0}


def test_encoders(spark):
    df = spark.createDataFrame([("x", 1.0, 5.0), ("y", 2.0, 5.0), ("x", 3.0, 5.0), (None, 4.0, 5.0)], "c string, v double, k double")
    fitted = encoders.fit_index(df, "c")
    assert {r["value"]: r["idx"] for r in fitted.collect()} == {"x": 0, "y": 1}
    assert sorted(r[0] for r in encoders.apply_index(df, fitted, "c").select("c_idx").collect()) == [-1, 0, 0, 1]
    hot = encoders.one_hot(df, {"c": ["x", "SPLITÃO (ACJ)"]})
    assert hot.columns == ["v", "k", "c_x", "c_SPLITÃO (ACJ)"] and sum(r["c_x"] for r in hot.collect()) == 2
    limits = encoders.fit_clip(df.withColumn("none", F.lit(None).cast("double")), ["v", "k", "none", "absent"])
    assert {r["column"] for r in limits.collect()} == {"v", "k"}
    assert {r["k"] for r in encoders.apply_clip(df, limits).collect()} == {0.0}
    t = encoders.fit_target(df, "c", "v", 10.0)
    got = encoders.apply_target(spark.createDataFrame([("x",), ("new",), (None,)], "c string"), t, "c").collect()
    assert [round(r[0], 6) for r in got] == [round((4 + 25) / 12, 6), 2.5, 2.5]
    nan = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b double")
    stats = {r["column"]: r for r in encoders.normalisation(nan.withColumn("e", F.lit(None).cast("double")), ["a", "b", "e"]).collect()}
    assert (stats["a"]["mean"], stats["a"]["max"]) == (2.0, 2.0) and (stats["e"]["mean"], stats["e"]["std"], stats["e"]["max"]) == (0.0, 1.0, 1.0)
    assert encoders.sanitised(nan).first()["a"] == 0.0
    assert encoders.dense(df, ["v", "k"]).first()["features"] == [1.0, 5.0]


def degree(km):
    return km / 111.19492664455873


def test_clusters(spark):
    points = [(0.0, 0.0), (degree(39), 0.0), (50.0, 0.0), (50.0 + degree(41), 0.0), (10.0, 179.9), (10.0, -179.9), (0.0, 0.0), (None, 1.0)]
    df = spark.createDataFrame(points, "latitude double, longitude double")
    got = {(r["latitude"], r["longitude"]): r["grupo_regional"] for r in geo.clusters(df, 40.0, 2).collect()}
    assert len(got) == 6 and got[(0.0, 0.0)] == got[(degree(39), 0.0)] == 0
    assert got[(50.0, 0.0)] != got[(50.0 + degree(41), 0.0)]
    assert got[(10.0, 179.9)] == got[(10.0, -179.9)] == 1  # across the date line
    assigned = geo.assign(spark.createDataFrame([(1, 0.1, 0.0), (2, None, 0.0), (3, 50.0, 0.0)], "id int, latitude double, longitude double"), geo.clusters(df, 40.0, 2))
    by_id = {r["id"]: r["grupo_regional"] for r in assigned.collect()}
    assert by_id == {1: 0, 2: None, 3: got[(50.0, 0.0)]}


def test_cluster_border_and_chain(spark):
    chain = [(degree(35 * i), 0.0) for i in range(4)]
    df = spark.createDataFrame(chain, "latitude double, longitude double")
    assert {r["grupo_regional"] for r in geo.clusters(df, 40.0, 2).collect()} == {0}
    three = geo.clusters(df, 40.0, 3)
    assert {r["grupo_regional"] for r in three.collect()} == {0} and three.filter("is_core").count() == 2
    assert geo.summary(three).first()["n_pontos"] == 4


def test_metrics(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("a", 2.0, 1.0), ("b", 0.0, 1.0)], "s string, y double, p double")
    got = {r["s"]: r for r in metrics.error_metrics(df, "y", "p", ["s"]).collect()}
    assert got["a"]["MAE"] == 0.5 and got["a"]["WMAPE"] == 50.0 and got["a"]["MAPE"] == 25.0
    assert got["b"]["WMAPE"] is None and got["b"]["R2"] is None
    per = spark.createDataFrame([(1, 1.0), (3, 2.0), (5, None)], "n_test int, MAE double")
    assert metrics.weighted(per, ["MAE"]).first()["MAE"] == 1.75
    tally = {r["winner"]: r["n"] for r in metrics.tally(df.withColumn("q", F.col("y")), "y", "p", "q").collect()}
    assert tally == {"challenger": 2, "tie": 1}


def test_rows(spark):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.0, "x")], "a int, b double, c string")
    assert rows.complete(df).count() == 1 and rows.complete(df, ["b"]).count() == 2
    assert rows.aligned(df, ["b", "zzz"]).columns == ["b", "zzz"]
    with pytest.raises(ValueError):
        rows.check_columns(df, ["a"], ["b"])
    bad = spark.createDataFrame([(24, 91.0, 101.0, -1.0), (23, 90.0, 100.0, 0.0), (None, 0.0, 0.0, 0.0)], "hora int, latitude double, `Umidade_Relativa_%` double, Precipitacao_mm double")
    assert [len(r["reasons"]) for r in rows.judged(bad).collect()] == [4, 0, 1]
    dated = spark.createDataFrame([("2024-01-02", "x-y-z"), (None, None)], "d string, e string")
    assert rows.date_like(dated) == ["d"] and rows.for_model(dated, ["e", "nope"]).dtypes == [("d", "date")]
    assert rows.named(df, {"a": "aa"}).columns[0] == "aa" and rows.with_target(df, "t").columns[-1] == "t"


def test_units(spark):
    units = spark.createDataFrame([("Loja, Centro", "03/18/25", 53, None), ("B", "03/18/25", None, 7)], "unit_name string, data_inicio string, dias_antes_automacao int, extra int")
    got = consolidate.prepared_units(units).collect()
    assert got[0]["data_instalacao"] == dt.date(2025, 1, 23) and got[1]["data_instalacao"] is None
    with pytest.raises(ValueError):
        consolidate.with_unit_id(units, units)
    assert consolidate.new_units(spark.createDataFrame([(1,)], "unit_id int"), spark.createDataFrame([(1,)], "unit_id int")).count() == 0


def test_consolidation(spark):
    d = dt.date(2024, 1, 5)
    devices = spark.createDataFrame([("A", 1, d, d), ("B", 1, d, d)], "device_code string, unit_id long, data_instalacao date, data_inicio_automacao date")
    avail = spark.createDataFrame([("A", d), ("A", d), ("B", d)], "device_code string, record_date date")
    places = spark.createDataFrame([("A", "t1", 1.0, 2.0), ("A", "t2", 1.0, 2.0)], "device_code string, machine_type string, latitude double, longitude double")
    hours = spark.createDataFrame([("A", d, 0, 1.0), ("A", d, 1, 0.0), ("A", d - dt.timedelta(1), 0, 1.0)], "device_id string, data date, hora long, consumo_kwh double")
    direct = consolidate.direct(hours, devices, avail, places)
    assert direct.count() == 2 and consolidate.direct(hours, devices, avail, places, once=False).count() == 4
    history = spark.createDataFrame([("A", dt.datetime(2024, 1, 5, 23), 2.0), ("B", dt.datetime(2024, 1, 5, 23), 3.0), ("B", dt.datetime(2024, 1, 6), 3.0)], "device_code string, record_date timestamp_ntz, consumption double")
    both = consolidate.consolidated(direct, consolidate.indirect(history, devices, avail, places))
    assert sorted((r["device_id"], r["metodo"], r["machine_type"]) for r in both.collect()) == [("A", "direto", "t1"), ("A", "direto", "t2"), ("B", "indireto", None)]


def test_device_places(spark):
    t = {
        "DEVICES": ([(1, "D1"), (2, "D2"), (3, "D3")], "ID long, DEVICE_CODE string"), "DUTS_DEVICES": ([(10, 1)], "ID long, DEVICE_ID long"), "DACS_DEVICES": ([(20, 2), (21, 3)], "ID long, DEVICE_ID long"),
        "DUTS_AUTOMATION": ([(10, 100)], "DUT_DEVICE_ID long, MACHINE_ID long"), "DACS_CONDENSERS": ([(20, 30), (21, 31)], "DAC_DEVICE_ID long, CONDENSER_ID long"), "CONDENSERS": ([(30, 100), (31, 101)], "ID long, MACHINE_ID long"),
        "MACHINES": ([(100, "self", 5), (101, "self", 6)], "ID long, TYPE string, UNIT_ID long"), "CLUNITS": ([(5, 1.0, 2.0), (6, None, None)], "UNIT_ID long, LAT double, LON double"),
    }
    got = associations.device_places({n: spark.createDataFrame(*x) for n, x in t.items()})
    assert sorted(r["device_code"] for r in got.collect()) == ["D1", "D2"]
    with pytest.raises(ValueError):
        associations.units_of_references(spark.range(1).withColumn("reference_id", F.col("id")), spark.range(0).withColumnRenamed("id", "reference_id"))


def test_profile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,)], "x double")
    h = profile.histogram(df, "x", 3).collect()
    assert [r["n"] for r in h] == [3, 3, 4] and abs(sum(r["share"] for r in h) - 10 / 11) < 1e-12
    assert [r["n"] for r in profile.histogram(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x").collect()] == [2]
    assert profile.distinct_counts(df, ["x"]).first()["x"] == 11
    assert profile.null_rates(df, ["x"]).first()["n_null"] == 1
    box = profile.box_numbers(spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4, 100)], "x double"), "x").first()
    assert box["n_above"] == 1 and box["n_below"] == 0


def test_sampling(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r["k"]: r["split"] for r in sampling.with_split(df, "k", 0.2, 0.1).collect()}
    b = {r["k"]: r["split"] for r in sampling.with_split(df.repartition(7), "k", 0.2, 0.1).collect()}
    assert a == b and 100 < sum(v == "test" for v in a.values()) < 300
    sizes = [r["count"] for r in sampling.folds(df, "k", 7).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [143] * 6 + [142]
    assert sampling.sample(df, "k", 10).collect() == sampling.sample(df.repartition(5), "k", 10).collect()


@pytest.mark.parametrize("distinct", [7, 50_000])
def test_quantile_brackets(spark, distinct):
    """Groups large enough for brackets give the ranks of a plain sort; null is a group."""
    n = 20_000
    df = spark.range(n * 3).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.pmod(F.col("id") * 7919 + 13, F.lit(distinct)) * 0.5).alias("v"))
    want = {"a": 0.0, "b": 0.001, "c": 0.25, "d": 0.9, "e": 0.9985, "f": 1.0}
    got = {r["g"]: r for r in quantiles.nearest(df, "v", want, ["g"]).collect()}
    for g in (None, 1, 2):
        values = sorted(r["v"] for r in df.filter(F.col("g").eqNullSafe(F.lit(g))).select("v").collect())
        assert got[g]["n"] == n and all(got[g][k] == values[int(q * (n - 1) + 0.5)] for k, q in want.items())


@pytest.mark.parametrize("most", [quantiles.MOST, 40])
def test_quantiles_of_skewed_groups(spark, monkeypatch, most):
    """A group of nearly all rows, one value of half of them, a long tail; also with brackets that must be narrowed again and again."""
    monkeypatch.setattr(quantiles, "MOST", most)
    monkeypatch.setattr(quantiles, "STEPS", 4)
    big = spark.range(60_000).select(F.lit("big").alias("g"), F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.exp(F.pmod(F.col("id") * 7919, F.lit(60_000)) / 3000.0)).alias("v"))
    df = big.unionByName(spark.range(9).select(F.lit("small").alias("g"), (F.col("id") * 1.0).alias("v"))).unionByName(spark.range(5000).select(F.lit("same").alias("g"), F.lit(3.0).alias("v")))
    want = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.77, "e": 0.999, "f": 1.0}
    got = {r["g"]: r for r in quantiles.nearest(df, "v", want, ["g"]).collect()}
    between = {r["g"]: r for r in quantiles.linear(df, "v", want, ["g"]).collect()}
    for g, rs in {k: sorted(r["v"] for r in df.filter(F.col("g") == k).select("v").collect()) for k in ("big", "small", "same")}.items():
        assert all(got[g][k] == rs[int(q * (len(rs) - 1) + 0.5)] for k, q in want.items())
        assert [between[g][k] for k in want] == pytest.approx(np.quantile(rs, list(want.values())).tolist())
    whole = quantiles.linear(df.limit(0), "v", {"m": 0.5}).collect()
    assert [tuple(r) for r in whole] == [(0, None)] and quantiles.nearest(df.limit(0), "v", {"m": 0.5}, ["g"]).count() == 0
