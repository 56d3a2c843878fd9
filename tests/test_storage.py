"""Committed versions, checked writes, and databases (Derby in memory, which Spark ships)."""

import os

import pytest
from pyspark.sql import functions as F

from wattlake.operators import rows, sampling, sketches
from wattlake.sources import checked, databases, tables, versions, weather


def table(spark, *pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def all_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.append(table(spark, (1, "a"), (2, "b"), (2, None)), path, ["k"]) == 1
    assert versions.append(table(spark, (2, "z"), (3, "c"), (3, "c"), (4, None), (4, "d")), path, ["k"]) == 2
    assert all_of(versions.read(spark, path)) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")] and all_of(versions.read(spark, path, 1)) == [(1, "a"), (2, "b")]
    assert all_of(versions.history(spark, path)) == [(1, 2, 2, 1), (2, 4, 2, 2)]
    with pytest.raises(ValueError):
        versions.append(table(spark, (None, "x")), path, ["k"])
    with pytest.raises(ValueError):
        versions.append(table(spark, (9, "x")).withColumn("v", F.lit(1)), path, ["k"])
    assert versions.replace(table(spark, (7, "g")), path, ["k"]) == 3 and all_of(versions.read(spark, path)) == [(7, "g")]
    assert versions.append(table(spark, (7, "h")), path, ["k"]) == 4 and all_of(versions.read(spark, path)) == [(7, "g")]  # nothing new
    assert versions.merged(spark, path) == 5 and len(versions.manifest(spark, path)["folders"]) == 1
    versions.tidy(spark, path, 2)
    assert versions.numbers(spark, path) == [4, 5] and all_of(versions.read(spark, path, 4)) == [(7, "g")]
    with pytest.raises(ValueError):
        versions.read(spark, path, 1)
    with pytest.raises(ValueError):
        versions.read(spark, str(tmp_path / "none"))
    empty = str(tmp_path / "e")
    assert versions.append(spark.createDataFrame([], "k int, v string"), empty, ["k"]) == 1 and versions.read(spark, empty).count() == 0


def test_a_write_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.append(table(spark, (1, "a")), path, ["k"])

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(versions, "_switch", killed)
        versions.append(table(spark, (2, "b")), path, ["k"])
    assert len(os.listdir(f"{path}/data")) == 2  # the data are there, no version names them
    assert all_of(versions.read(spark, path)) == [(1, "a")]
    assert any("data/" in g for g in versions.tidy(spark, path)) and len(os.listdir(f"{path}/data")) == 1
    assert versions.append(table(spark, (2, "b")), path, ["k"]) == 2 and versions.read(spark, path).count() == 2


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    path, switch = str(tmp_path / "t"), versions._switch
    versions.append(table(spark, (1, "a")), path, ["k"])

    def late(*args):
        monkeypatch.setattr(versions, "_switch", switch)
        versions.append(table(spark, (2, "other")), path, ["k"])  # somebody else is faster
        switch(*args)

    monkeypatch.setattr(versions, "_switch", late)
    with pytest.raises(versions.Conflict):
        versions.append(table(spark, (2, "mine")), path, ["k"])
    assert all_of(versions.read(spark, path)) == [(1, "a"), (2, "other")]


def test_weather_cache_grows_by_versions(spark, tmp_path):
    path = str(tmp_path / "w")
    hours = spark.createDataFrame([(1.0, 2.0, "2024-01-01", 0, 5.0), (1.0, 2.0, "2024-01-01", 0, None), (1.0, 2.0, "2024-01-01", 1, 6.0)], "latitude double, longitude double, data_str string, hora long, Temperatura_C double")
    assert weather.extend_cache(hours, path) == 1 and weather.extend_cache(hours.withColumn("hora", F.col("hora") + 1), path) == 2
    got = all_of(versions.read(spark, path).select("hora", "Temperatura_C"))
    assert got == [(0, 5.0), (1, 6.0), (2, 6.0)]
    wanted = spark.createDataFrame([(1.0, 2.0, "2024-01-01", 0), (1.0, 2.0, "2024-01-02", 0)], "latitude double, longitude double, data_str string, hora long")
    assert all_of(weather.attach(wanted, hours).select("hora", "Temperatura_C")) == [(0, 5.0), (0, None)]  # the fuller row


def jobs_scanning(spark, name, run):
    """Runs *run* and returns how many stages read input in it."""
    spark.sparkContext.setJobGroup(name, name)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    return [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(name)]


def test_checks_come_with_the_write(spark, tmp_path):
    source, path = str(tmp_path / "s"), str(tmp_path / "c")
    spark.createDataFrame([(1, 5.0, 2.0), (24, 1.0, 2.0), (3, None, 1.0), (None, 1.0, 1.0), (4, float("nan"), -1.0)], "hora int, x double, y double").write.parquet(source)
    df, found = spark.read.parquet(source), []
    stages = jobs_scanning(spark, "checked write", lambda: found.append(checked.write(df, path, ["hora", "x", "nope"], ["y"])))
    assert stages == [1]  # one job of one stage reads, judges, counts and writes
    assert {r["check"]: (r["passed"], r["detail"]) for r in found[0].collect()} == {"columns": (False, "nope"), "rows": (True, "3"), "complete": (False, "x: 1 null, 1 NaN"), "y positive": (False, ""), "in range": (False, "2")}
    assert checked.read(spark, path).columns == ["hora", "x", "y"] and checked.read(spark, path).count() == 3
    assert all_of(checked.read(spark, path, checked.REJECTED).select("hora", "reasons")) == [(24, ["hora"]), (None, ["hora"])]
    rates = checked.null_rates(df, str(tmp_path / "n"))
    assert all_of(rates) == [("hora", 1, 0.2), ("x", 1, 0.2), ("y", 0, 0.0)]
    assert all_of(checked.null_rates(df.limit(0), str(tmp_path / "m"))) == [("hora", 0, 0.0), ("x", 0, 0.0), ("y", 0, 0.0)]


def test_databases(spark, sf_dir):
    url, driver = "jdbc:derby:memory:wattlake;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
    skewed = o.unionByName(spark.range(800).select((F.lit(10**12) + F.col("id") % 3).alias("o_orderkey"), F.lit(7).cast("long").alias("o_custkey"), F.lit("it's").alias("o_orderpriority"))).unionByName(spark.range(5).select(F.lit(None).cast("long").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("none").alias("o_orderpriority")))
    skewed.coalesce(1).write.option("createTableColumnTypes", "o_orderpriority VARCHAR(40)").jdbc(url, "orders", mode="overwrite", properties={"driver": driver})
    n = skewed.count()
    cuts = databases.ranges(spark, url, "orders", "o_orderkey", 6, driver=driver)
    df = databases.read(spark, url, "orders", "o_orderkey", 6, driver=driver)
    assert df.rdd.getNumPartitions() == len(cuts) >= 5 and all_of(df) == all_of(skewed)
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 0.45 * n  # a band at 10**12 next to keys under 10**4 is parted, too
    assert databases.ranges(spark, url, "orders", "o_custkey", 1, driver=driver) == ["1 = 1"]
    assert all_of(databases.read(spark, url, "orders", driver=driver).filter("o_custkey = 7")) == all_of(skewed.filter("o_custkey = 7"))
    some = [r[0] for r in o.select("o_orderkey").limit(1200).collect()]
    got = databases.members(spark, url, "orders", "o_orderkey", [*some, *some[:9], None], driver=driver)
    assert got.rdd.getNumPartitions() == 3 and all_of(got) == all_of(o.join(spark.createDataFrame([(k,) for k in some], "o_orderkey long"), "o_orderkey").select(o.columns))
    assert databases.members(spark, url, "orders", "o_orderpriority", ["it's"], driver=driver).count() == 800 and databases.members(spark, url, "orders", "o_orderkey", [], driver=driver).count() == 0
    wanted = spark.createDataFrame([(some[0],), (-5,), (-5,), (None,)], "o_orderkey long")
    assert all_of(databases.lacking(spark, url, "orders", "o_orderkey", wanted, driver=driver)) == [(-5,)]
    assert tables.jdbc(spark, url, "orders", "o_custkey", (1, 100), 4, driver=driver).count() == n


def test_paths_are_compared_as_folders(spark, tmp_path):
    a, b = str(tmp_path / "data_new"), str(tmp_path / "data")
    tables.write_parquet(spark.range(3), a)
    tables.write_parquet(tables.read_parquet(spark, a), b)  # a sibling whose name begins alike
    for path in (b, f"{b}/part", str(tmp_path), f"file:{b}/"):
        with pytest.raises(ValueError):
            tables.write_parquet(tables.read_parquet(spark, b).join(spark.range(2), "id"), path)
    assert tables.read_parquet(spark, b).count() == 3


def test_what_is_no_date_stays_or_is_named(spark):
    codes = spark.createDataFrame([("AB-12-3456", "2024-01-02"), ("CD-99-0000", None)], "c string, d string")
    assert rows.date_like(codes) == ["d"] and rows.for_model(codes.na.fill("2024-01-03"), []).count() == 2
    with pytest.raises(ValueError, match="1 of 3"):
        rows.for_model(spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("unknown",)], "d string"), [])
    assert rows.for_model(spark.createDataFrame([("2024-01-01",), ("x",), ("y",)], "d string"), []).count() == 3
    assert rows.date_like(spark.createDataFrame([(None,)], "d string")) == []


def test_keys_of_any_size_have_buckets(spark):
    keys = [4 * 10**13, -(2**63), 2**63 - 1, 0, 12345, -7, None]
    got = {r["k"]: r["b"] for r in spark.createDataFrame([(k,) for k in keys], "k long").select("k", sampling.bucket("k").alias("b")).collect()}
    for k in keys[:-1]:
        rest = k % 101 if k >= 0 else -(-k % 101)
        assert got[k] == ((k * 7919 + 42 * 104_729) * 31 + rest) % 10_000
    assert got[None] is None
    split = sampling.with_split(spark.createDataFrame([(k,) for k in keys], "k long"), "k").filter("k is null").first()
    assert split["split"] == "train" and sampling.sample(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 6).filter("k is null").count() == 0


def test_one_of_each_is_the_fullest(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 2, "b"), (1, 2, "a"), (None, 1, None), (None, None, "x")], "k int, a int, b string").repartition(4)
    assert all_of(rows.one_of_each(df, ["k"])) == [(1, 2, "a"), (None, None, "x")]  # as many nulls: a null is the least


def test_profiles_merge(spark, tmp_path):
    """Sketches of parts, kept as Parquet and merged after the rows are gone, against a recount of all rows."""
    df = spark.range(120_000).select((F.col("id") % 50_000).alias("k"), F.when(F.col("id") % 10 > 0, F.concat(F.lit("v"), F.pmod(F.floor(F.sqrt("id")), F.lit(40)))).alias("s"), F.lit(None).cast("double").alias("none"), (F.col("id") * 1.0).alias("x"))
    for i in range(4):
        sketches.profile(df.filter(F.col("x") % 4 == i)).write.parquet(str(tmp_path / f"{i}"))
    parts = [spark.read.parquet(str(tmp_path / f"{i}")) for i in range(4)]
    found = sketches.merged(sketches.merged(*parts[:3]), parts[3])
    got = {r["column"]: r for r in sketches.summary(found).collect()}
    assert [got[c]["n_null"] for c in ("k", "s", "none", "x")] == [0, 12_000, 120_000, 0] and {r["n"] for r in got.values()} == {120_000}
    assert abs(got["k"]["n_distinct"] - 50_000) < 0.04 * 50_000 and got["s"]["n_distinct"] == 40 and got["none"]["n_distinct"] == 0
    assert (got["x"]["low"], got["x"]["high"], got["s"]["low"], got["s"]["least"]) == (0.0, 119_999.0, None, "v0")
    want = {r["s"]: r["count"] for r in df.filter("s is not null").groupBy("s").count().collect()}
    top = {r["value"]: r["n"] for r in sketches.frequent(found, 40).filter("column = 's'").collect()}
    assert top == want
    ranks = {(r["column"], r["share"]): r["value"] for r in sketches.quantiles(found, [0.0, 0.5, 1.0]).collect()}
    assert ranks["x", 0.0] == 0 and ranks["x", 1.0] == 119_999 and abs(ranks["x", 0.5] - 60_000) < 0.03 * 120_000 and ("s", 0.5) not in ranks


CASES = [
    ("a;b;c\n1;2;3\n4;5;6\n", ";"), ("a,b\n1,2\n", ","), ("a\tb\n1\t2\n", "\t"), ("a|b\n1|2\n", "|"),
    ('name;note\n"x";"a, b, c"\n"y";"d, e, f"\n', ";"), ("date;amount\n1,5;2,5\n3,5;4,5\n", None), ("one\ntwo\nthree\n", ","), ("", ","), ("a;b,c\n", None), ("x" * 3000 + ";y\n", None), ("a;b\r\n1;2\r\n", ";"),
]


@pytest.mark.parametrize("text, want", CASES)
def test_separators(spark, tmp_path, text, want):
    """As the rule has it: the sniffer on 2,048 characters, else the first separator in the first line."""
    import csv

    (tmp_path / "f.csv").write_text(text, newline="")
    sample = text.replace("\r\n", "\n")[:2048]
    try:
        rule = csv.Sniffer().sniff(sample, ";,\t|").delimiter
    except csv.Error:
        rule = next((s for s in ";,\t|" if s in sample.split("\n")[0]), ",")
    assert tables.separator_of(spark, str(tmp_path / "f.csv")) == rule and want in (None, rule)
