import datetime as dt

from pyspark.sql import functions as F

from wattlake.functions import dates, machines, scalars


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def day(s):
    return F.lit(s).cast("date")


def test_season_boundaries(spark):
    wanted = {"2024-03-20": "verao", "2024-03-21": "outono", "2024-06-20": "outono", "2024-06-21": "inverno", "2024-09-22": "inverno", "2024-09-23": "primavera", "2024-12-20": "primavera", "2024-12-21": "verao", "2024-02-29": "verao"}
    assert one(spark, *[dates.season_of_day(day(d)) for d in wanted]) == tuple(wanted.values())
    assert one(spark, dates.season_of_day(F.lit(None).cast("date")), dates.season_of_month(F.lit(None).cast("int"))) == ("primavera", "desconhecida")


def test_day_periods(spark):
    assert one(spark, *[dates.period(F.lit(h)) for h in (0, 6, 7, 11, 12, 18, 19, 23)]) == ("Madrugada",) * 2 + ("Manhã",) * 2 + ("Tarde",) * 2 + ("Noite",) * 2
    assert one(spark, dates.period_id(F.lit(None).cast("int"))) == (3,)


def test_good_friday(spark):
    years = (2024, 2025, 2026, 1999, 1954, 1981, 2049, 2285, 1583)
    fridays = [(2024, 3, 29), (2025, 4, 18), (2026, 4, 3), (1999, 4, 2), (1954, 4, 16), (1981, 4, 17), (2049, 4, 16), (2285, 3, 20), (1583, 4, 8)]
    assert one(spark, *[dates.good_friday(F.lit(y)) for y in years]) == tuple(dt.date(*d) for d in fridays)


def test_calendar(spark):
    rows = [("2024-12-31",), ("2025-01-01",), ("2025-04-17",), ("2025-04-18",), ("2024-11-20",), ("2023-11-20",), ("2025-03-15",), ("2025-05-01",)]
    df = spark.createDataFrame(rows, "d string").withColumn("d", F.col("d").cast("date"))
    got = {str(r["d"]): (r["feriado"], r["vespera_feriado"], r["dia_util"]) for r in dates.with_calendar(df, "d").collect()}
    assert got["2024-12-31"] == (0, 1, 1) and got["2025-01-01"] == (1, 0, 0)
    assert got["2025-04-17"] == (0, 1, 1) and got["2025-04-18"] == (1, 0, 0)
    assert got["2024-11-20"][0] == 1 and got["2023-11-20"][0] == 0 and got["2025-03-15"] == (0, 0, 0) and got["2025-05-01"][0] == 1


def test_machine_types(spark):
    names = ["Split-Wall", "split wall", "Fancoil", "", "  ", None, "self", "Something New"]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    assert [r[0] for r in df.select(machines.machine_type("t")).collect()] == ["SPLIT HI-WALL", "SPLIT HI-WALL", "FANCOIL", machines.UNKNOWN, machines.UNKNOWN, machines.UNKNOWN, "SPLITÃO SELF CONTAINED", "something new"]
    assert df.select(machines.machine_type("t", fold_keys=False)).collect()[2][0] == "fancoil"


def test_scalars(spark):
    assert one(spark, scalars.piece(F.lit("2.5*60"), "*", 1), scalars.piece(F.lit("3"), "*", 1)) == ("60", None)
    assert one(spark, scalars.number(F.lit("abc")), scalars.number(F.lit(" 3 "))) == (None, 3.0)
    assert one(spark, scalars.json_scalar(F.lit('{"Curr":"1,2"}'), "Curr"), scalars.json_scalar(F.lit('{"Curr":[1]}'), "Curr"), scalars.json_scalar(F.lit("{}"), "Curr")) == ("1,2", None, None)
    assert one(spark, scalars.int_range(F.lit(2), F.lit(1)), scalars.int_range(F.lit(1), F.lit(2))) == ([], [1, 2])
    assert one(spark, scalars.clip(F.lit(None).cast("double"), 0.0, 1.0), scalars.min_max(F.lit(5.0), 5.0, 5.0), scalars.min_max(F.lit(9.0), 0.0, 5.0)) == (None, 0.0, 1.0)
    assert one(spark, *[scalars.sane(F.lit(x)) for x in (float("nan"), float("inf"), float("-inf"), 2.0)]) == (0.0, 0.0, 0.0, 2.0)
    assert one(spark, scalars.date_of(F.lit("03/18/25")), scalars.date_of(F.lit("3/8/25")), scalars.date_of(F.lit("x"))) == (dt.date(2025, 3, 18), dt.date(2025, 3, 8), None)
    assert one(spark, scalars.safe_name(F.lit("a/b c")), scalars.override_key(F.lit("split hi-wall")), scalars.family(F.lit("DAC123456789"))) == ("a_b_c", "SPLIT HI WALL", "DAC12345")
    assert abs(one(spark, scalars.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))[0] - 111.1949) < 1e-3
    assert one(spark, scalars.relative_error(F.lit(0.0), F.lit(1e-8)), scalars.replaced(F.lit("q"), {"a": "b"})) == (100.0, "q")


def test_hours(spark):
    assert one(spark, scalars.hour_stamp(day("2024-03-10"), F.lit(2))) == (dt.datetime(2024, 3, 10, 2),)
    sine, cosine = scalars.cyclical(F.lit(6), 24)
    assert [round(x, 9) for x in one(spark, sine, cosine)] == [1.0, 0.0] and one(spark, scalars.overlap(F.lit(10.0), F.lit(20.0), F.lit(15.0), F.lit(40.0))) == (5.0,)
