"""The registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.functions import dates, machines, scalars
from wattlake.operators import associations, consolidate, encoders, geo, gram, hourly, lags, metrics, outliers, profile, quantiles, rows, sampling, sketches
from wattlake.plans import enrich, features, raw, training, views
from wattlake.plans.views import OBSERVED, PAYLOAD, POINTS, TELEMETRY, table, telemetry
from wattlake.session import shared_folder
from wattlake.sources import checked, tables, versions, weather

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# hourly series ------------------------------------------------------------------------------


@query(f"""WITH {TELEMETRY}, m AS (SELECT unit_id, machine_type, data, hora, avg(consumo_kwh) AS v, data + to_hours(CAST(hora AS INTEGER)) AS t FROM tel GROUP BY ALL),
w AS (SELECT *, lag(v) OVER o AS pv, lag(t) OVER o AS pt, avg(v) OVER (PARTITION BY unit_id, machine_type ORDER BY t ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS r FROM m WINDOW o AS (PARTITION BY unit_id, machine_type ORDER BY t))
SELECT w.unit_id, w.machine_type, w.data, w.hora, round(CASE WHEN w.t - w.pt = INTERVAL 1 HOUR THEN w.pv END, 8) AS consumo_lag_1h, round(y.v, 8) AS consumo_lag_24h, round(w.r, 8) AS consumo_rolling_mean_3h
FROM w LEFT JOIN m y ON y.unit_id = w.unit_id AND y.machine_type = w.machine_type AND y.hora = w.hora AND y.data + 1 = w.data""")
def hourly_lags(spark, sf_dir):
    return lags.with_lags(telemetry(spark, sf_dir), digits=8)


@query(f"""WITH {TELEMETRY}, m AS (SELECT unit_id, machine_type, data, hora, avg(consumo_kwh) AS v FROM tel GROUP BY ALL)
SELECT unit_id, machine_type, data, hora, round(v, 6) AS consumo_kwh FROM m""")
def hourly_mean(spark, sf_dir):
    return lags.hourly_mean(telemetry(spark, sf_dir)).withColumn("consumo_kwh", F.round("consumo_kwh", 6))


@query(f"""WITH {TELEMETRY}, m AS (SELECT unit_id, machine_type, data, hora, avg(consumo_kwh) AS v, data + to_hours(CAST(hora AS INTEGER)) AS t FROM tel GROUP BY ALL),
l AS (SELECT unit_id, machine_type, data, hora, round(avg(v) OVER (PARTITION BY unit_id, machine_type ORDER BY t RANGE BETWEEN INTERVAL 2 HOURS PRECEDING AND CURRENT ROW), 8) AS r FROM m)
SELECT event_id, r AS consumo_rolling_mean_3h FROM tel JOIN l USING (unit_id, machine_type, data, hora)""")
def lags_on_detail_rows(spark, sf_dir):
    return lags.add_lags(telemetry(spark, sf_dir), mode="range", digits=8).select("event_id", "consumo_rolling_mean_3h")


_PARTS = f"""{PAYLOAD}, x AS (SELECT 'DAC' || user_id AS dev_id, day, unnest(string_split(json_extract_string(charts_detailed, '$.Curr'), ',')) AS part, generate_subscripts(string_split(json_extract_string(charts_detailed, '$.Curr'), ','), 1) AS idx FROM rle),
p AS (SELECT dev_id, day, idx, try_cast(string_split(trim(part), '*')[1] AS DOUBLE) AS amps, coalesce(try_cast(string_split(trim(part), '*')[2] AS DOUBLE), 1.0) AS seconds FROM x WHERE trim(part) <> '' AND NOT starts_with(trim(part), '*')),
c AS (SELECT *, sum(seconds) OVER (PARTITION BY dev_id, day ORDER BY idx ROWS UNBOUNDED PRECEDING) AS e FROM p WHERE amps IS NOT NULL AND seconds > 0)"""


@query(f"""WITH {_PARTS}, h AS (SELECT dev_id, day, amps, e - seconds AS s, e, unnest(generate_series(CAST(floor((e - seconds) / 3600) AS BIGINT), CAST(floor((e - 1) / 3600) AS BIGINT))) AS hora FROM c)
SELECT dev_id AS device_id, day AS data, hora, round(sum(310.94::DOUBLE * amps * greatest(least(e, (hora + 1) * 3600.0::DOUBLE) - greatest(s, hora * 3600.0::DOUBLE), 0.0::DOUBLE) / 3600 / 1000), 9) AS consumo_kwh
FROM h WHERE hora BETWEEN 0 AND 23 GROUP BY 1, 2, 3""")
def hourly_apportionment(spark, sf_dir):
    return hourly.hourly_energy(views.run_lengths(spark, sf_dir), prefix="DAC", digits=9)


@query(f"WITH {_PARTS} SELECT dev_id, day, CAST(idx - 1 AS INTEGER) AS idx, amps, seconds, e - seconds AS start_s, e AS end_s FROM c")
def sample_spans(spark, sf_dir):
    return hourly.spans(hourly.samples(views.run_lengths(spark, sf_dir))).select("dev_id", "day", "idx", "amps", "seconds", "start_s", "end_s")


# consolidation ------------------------------------------------------------------------------

_ROLES = f"""{TELEMETRY}, dates AS (SELECT unit_id, DATE '2024-01-04' + CAST(unit_id AS INTEGER) AS data_instalacao, DATE '2024-01-20' + CAST(unit_id AS INTEGER) AS data_inicio_automacao FROM (SELECT DISTINCT unit_id FROM tel)),
avail AS (SELECT device_id AS device_code, data AS record_date, unit_id, 60.0::DOUBLE + CAST(sum(event_id) % 41 AS DOUBLE) AS disponibility FROM tel GROUP BY 1, 2, 3),
places AS (SELECT DISTINCT device_id AS device_code, machine_type, -33.0::DOUBLE + unit_id AS latitude, -60.0::DOUBLE + unit_id AS longitude FROM tel WHERE machine_type <> ' ' AND hora < 6)"""


def roles(spark, sf_dir) -> dict[str, DataFrame]:
    tel = telemetry(spark, sf_dir)
    start = F.date_add(F.lit("2024-01-04").cast("date"), F.col("unit_id").cast("int"))
    unit_dates = tel.select("unit_id").distinct().select("unit_id", start.alias("data_instalacao"), F.date_add(start, 16).alias("data_inicio_automacao"))
    avail = tel.groupBy(F.col("device_id").alias("device_code"), F.col("data").alias("record_date"), "unit_id").agg((F.lit(60.0) + F.sum("event_id") % 41).alias("disponibility"))
    place = tel.filter("machine_type <> ' ' and hora < 6").select(F.col("device_id").alias("device_code"), "machine_type", (F.lit(-33.0) + F.col("unit_id")).alias("latitude"), (F.lit(-60.0) + F.col("unit_id")).alias("longitude")).distinct()
    devices = associations.available_devices(avail, unit_dates).join(unit_dates, "unit_id")
    return {"tel": tel, "dates": unit_dates, "avail": avail, "places": place, "devices": devices}


_DEVICES = "dv AS (SELECT device_code, min(unit_id) AS unit_id FROM avail WHERE disponibility >= 75 AND unit_id IN (SELECT unit_id FROM dates) GROUP BY 1), devices AS (SELECT dv.*, data_instalacao, data_inicio_automacao FROM dv JOIN dates USING (unit_id)), gate AS (SELECT DISTINCT device_code, record_date FROM avail WHERE disponibility >= 75)"
_COLUMNS = "unit_id, device_id, substr(device_id, 1, 8) AS device_version, hora, data, consumo_kwh, data_instalacao, data_inicio_automacao"
_DIRECT = f"""dir0 AS (SELECT device_id, data, hora, round(sum(consumo_kwh), 6) AS consumo_kwh FROM tel WHERE event_id % 3 <> 0 AND right(device_id, 1) <> '7' GROUP BY 1, 2, 3),
dir AS (SELECT {_COLUMNS.replace('unit_id', 'd.unit_id', 1)}, 'direto' AS metodo, p.machine_type, p.latitude, p.longitude FROM dir0 JOIN devices d ON device_id = d.device_code JOIN gate g ON g.device_code = device_id AND g.record_date = data LEFT JOIN places p ON p.device_code = device_id WHERE data BETWEEN data_instalacao AND data_inicio_automacao AND consumo_kwh > 0)"""
_INDIRECT = f"""ind AS (SELECT {_COLUMNS.replace('unit_id', 'd.unit_id', 1)}, 'indireto' AS metodo, p.machine_type, p.latitude, p.longitude FROM tel t0 JOIN devices d ON device_id = d.device_code JOIN gate g ON g.device_code = device_id AND g.record_date = data LEFT JOIN places p ON p.device_code = device_id WHERE ts >= data_instalacao AND ts < data_inicio_automacao + 1 AND consumo_kwh > 0)"""
_INDIRECT = _INDIRECT.replace("p.machine_type", "p.machine_type", 1).replace("d.unit_id, device_id", "d.unit_id AS unit_id, device_id")


def _gate(r):
    return r["avail"].filter("disponibility >= 75").select("device_code", "record_date").distinct()


def _direct_hours(r):
    return r["tel"].filter("event_id % 3 <> 0 and right(device_id, 1) <> '7'").groupBy("device_id", "data", "hora").agg(F.round(F.sum("consumo_kwh"), 6).alias("consumo_kwh"))


def _direct(r):
    return consolidate.direct(_direct_hours(r), r["devices"], _gate(r), r["places"])


def _indirect(r):
    history = r["tel"].select(F.col("device_id").alias("device_code"), F.col("ts").alias("record_date"), F.col("consumo_kwh").alias("consumption"))
    return consolidate.indirect(history, r["devices"], _gate(r), r["places"])


@query(f"WITH {_ROLES}, {_DEVICES}, {_DIRECT} SELECT * FROM dir")
def consolidate_direct(spark, sf_dir):
    return _direct(roles(spark, sf_dir))


# availability repeats on some days: an inner gate repeats consumption as often, a semi gate doesn't
@query(f"WITH {_ROLES}, {_DEVICES}, {_DIRECT.replace('JOIN gate g', 'JOIN gate2 g')} SELECT * FROM dir".replace("gate AS (SELECT DISTINCT", "gate2 AS (SELECT device_code, record_date FROM avail, generate_series(0, CAST(day(record_date) % 2 AS INTEGER)) WHERE disponibility >= 75), gate AS (SELECT DISTINCT"))
def consolidate_direct_repeated(spark, sf_dir):
    r = roles(spark, sf_dir)
    enough = r["avail"].filter("disponibility >= 75").select("device_code", "record_date")  # a row for each unit of a device: they repeat too
    twice = enough.withColumn("_n", F.explode(F.sequence(F.lit(0), F.day("record_date") % 2))).drop("_n")
    return consolidate.direct(_direct_hours(r), r["devices"], twice, r["places"], once=False)


@query(f"WITH {_ROLES}, {_DEVICES}, {_INDIRECT} SELECT * FROM ind")
def consolidate_indirect(spark, sf_dir):
    return _indirect(roles(spark, sf_dir))


@query(f"WITH {_ROLES}, {_DEVICES}, {_DIRECT}, {_INDIRECT} SELECT * FROM dir UNION ALL SELECT * FROM ind WHERE device_id NOT IN (SELECT device_id FROM dir)")
def consolidate_direct_first(spark, sf_dir):
    r = roles(spark, sf_dir)
    return consolidate.consolidated(_direct(r), _indirect(r))


@query(f"WITH {_ROLES}, {_DEVICES} SELECT device_code, unit_id FROM devices")
def available_devices(spark, sf_dir):
    return roles(spark, sf_dir)["devices"].select("device_code", "unit_id")


@query(f"WITH {_ROLES}, {_DEVICES} SELECT DISTINCT device_code, record_date FROM avail WHERE disponibility >= 75 AND record_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' AND device_code IN (SELECT device_code FROM devices)")
def available_days(spark, sf_dir):
    r = roles(spark, sf_dir)
    return associations.available_days(r["avail"], r["devices"], "2024-01-10", "2024-01-12")


@query(f"WITH {TELEMETRY} SELECT DISTINCT substr(device_id, 1, 8) AS family FROM tel WHERE consumo_kwh > 200")
def families_with_current(spark, sf_dir):
    t = telemetry(spark, sf_dir).select(F.col("device_id").alias("device_code"), (F.col("consumo_kwh") - 200).alias("consumption_ah"))
    return consolidate.versions_with_current(t, associations.families_with_current(t))


@query(f"WITH {TELEMETRY} SELECT DISTINCT unit_id FROM tel WHERE unit_id NOT IN (SELECT unit_id FROM tel WHERE consumo_kwh > 350)")
def incremental_units(spark, sf_dir):
    t = telemetry(spark, sf_dir)
    return consolidate.new_units(t.select("unit_id").distinct(), t.filter("consumo_kwh > 350"))


# associations -------------------------------------------------------------------------------

@query("""SELECT 'C' || c.c_custkey AS device_code, p.p_type AS machine_type, n.n_name AS place FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey JOIN nation n ON n.n_nationkey = c.c_nationkey
UNION SELECT 'S' || s.s_suppkey, p.p_type, n.n_name FROM supplier s JOIN lineitem l ON l.l_suppkey = s.s_suppkey JOIN part p ON p.p_partkey = l.l_partkey JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def device_places(spark, sf_dir):
    t = {n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem", "part", "nation", "supplier")}
    line, part, nation = t["lineitem"].select("l_orderkey", "l_suppkey", "l_partkey"), t["part"].select("p_partkey", "p_type"), t["nation"].select("n_nationkey", "n_name")
    bought = associations.path(t["customer"], (t["orders"].select("o_orderkey", "o_custkey"), "c_custkey", "o_custkey"), (line, "o_orderkey", "l_orderkey"), (part, "l_partkey", "p_partkey"), (nation, "c_nationkey", "n_nationkey"))
    sold = associations.path(t["supplier"], (line, "s_suppkey", "l_suppkey"), (part, "l_partkey", "p_partkey"), (nation, "s_nationkey", "n_nationkey"))
    pick = lambda df, letter, key: df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("device_code"), F.col("p_type").alias("machine_type"), F.col("n_name").alias("place"))
    return associations.union_distinct(pick(bought, "C", "c_custkey"), pick(sold, "S", "s_suppkey"))


_TABLES = """dev AS (SELECT c_custkey AS "ID", 'D' || c_custkey AS "DEVICE_CODE" FROM customer), dut AS (SELECT c_custkey * 2 AS "ID", c_custkey AS "DEVICE_ID" FROM customer WHERE c_custkey % 3 <> 0), aut AS (SELECT DISTINCT o_custkey * 2 AS d, o_orderkey % 97 AS m FROM orders),
dac AS (SELECT c_custkey * 5 AS "ID", c_custkey AS "DEVICE_ID" FROM customer WHERE c_custkey % 3 <> 1), dc AS (SELECT DISTINCT o_custkey * 5 AS d, o_orderkey % 53 AS c FROM orders), cond AS (SELECT p_partkey AS "ID", p_partkey % 97 AS m FROM part WHERE p_partkey <= 53),
mach AS (SELECT p_partkey AS m, p_type AS "TYPE", p_size % 25 AS u FROM part WHERE p_partkey < 97), unit AS (SELECT n_nationkey AS u, CASE WHEN n_nationkey % 4 <> 0 THEN CAST(n_nationkey * -1.5 AS DOUBLE) END AS lat, CAST(n_nationkey * 2.5 AS DOUBLE) AS lon FROM nation)"""


@query(f"""WITH {_TABLES}, p AS (SELECT "DEVICE_CODE" AS device_code, m FROM dev JOIN dut ON dut."DEVICE_ID" = dev."ID" JOIN aut ON aut.d = dut."ID" UNION ALL SELECT "DEVICE_CODE", cond.m FROM dev JOIN dac ON dac."DEVICE_ID" = dev."ID" JOIN dc ON dc.d = dac."ID" JOIN cond ON cond."ID" = dc.c)
SELECT DISTINCT device_code, "TYPE" AS machine_type, lat AS latitude, lon AS longitude FROM p JOIN mach USING (m) JOIN unit USING (u) WHERE lat IS NOT NULL""")
def places_of_devices(spark, sf_dir):
    c, o, p = (table(spark, sf_dir, n) for n in ("customer", "orders", "part"))
    key, order, part = F.col("c_custkey"), F.col("o_orderkey"), F.col("p_partkey")
    unit = F.col("n_nationkey")
    return associations.device_places({
        "DEVICES": c.select(key.alias("ID"), F.concat(F.lit("D"), key.cast("string")).alias("DEVICE_CODE")),
        "DUTS_DEVICES": c.filter(key % 3 != 0).select((key * 2).alias("ID"), key.alias("DEVICE_ID")),
        "DUTS_AUTOMATION": o.select((F.col("o_custkey") * 2).alias("DUT_DEVICE_ID"), (order % 97).alias("MACHINE_ID")),
        "DACS_DEVICES": c.filter(key % 3 != 1).select((key * 5).alias("ID"), key.alias("DEVICE_ID")),
        "DACS_CONDENSERS": o.select((F.col("o_custkey") * 5).alias("DAC_DEVICE_ID"), (order % 53).alias("CONDENSER_ID")),
        "CONDENSERS": p.filter(part <= 53).select(part.alias("ID"), (part % 97).alias("MACHINE_ID")),
        "MACHINES": p.filter(part < 97).select(part.alias("ID"), F.col("p_type").alias("TYPE"), (F.col("p_size") % 25).alias("UNIT_ID")),
        "CLUNITS": table(spark, sf_dir, "nation").select(unit.alias("UNIT_ID"), F.when(unit % 4 != 0, unit * -1.5).cast("double").alias("LAT"), (unit * 2.5).cast("double").alias("LON")),
    })


_SIX = " UNION ALL ".join(f"SELECT '{kind}' || {key} AS device_code, n_nationkey AS unit_id, n_name AS unit_name FROM {t} JOIN nation ON n_nationkey = {nat} WHERE {key} % 3 = {k}" for k in range(3) for kind, t, key, nat in (("C", "customer", "c_custkey", "c_nationkey"), ("S", "supplier", "s_suppkey", "s_nationkey")))


@query(f"WITH six AS ({_SIX}) SELECT DISTINCT device_code, unit_id, unit_name FROM six WHERE unit_name IN (SELECT n_name FROM nation WHERE n_regionkey < 2)")
def devices_of_units(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    paths = [
        associations.path(table(spark, sf_dir, t).filter(F.col(key) % 3 == k), (nation, nat, "n_nationkey")).select(F.concat(F.lit(kind), F.col(key).cast("string")).alias("device_code"), F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit_name"))
        for k in range(3) for kind, t, key, nat in (("C", "customer", "c_custkey", "c_nationkey"), ("S", "supplier", "s_suppkey", "s_nationkey"))
    ]
    names = nation.filter("n_regionkey < 2").select(F.col("n_name").alias("unit_name"))
    return associations.devices_of_units(paths, names).select("device_code", "unit_id", "unit_name")


@query("SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS city_id FROM customer WHERE c_acctbal > 0")
def distinct_cities(spark, sf_dir):
    return associations.cities(table(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_nationkey").cast("string")).alias("city_id")))


@query("SELECT c_custkey AS id, c_nationkey AS reference_id FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def units_of_references(spark, sf_dir):
    units = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("reference_id"))
    return associations.units_of_references(units, table(spark, sf_dir, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("reference_id")))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def first_row_per_key(spark, sf_dir):
    return associations.first_of(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) BETWEEN CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) + 30 AND l_extendedprice > 0")
def validity_window(spark, sf_dir):
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("first"))
    joined = line.join(orders, line["l_orderkey"] == orders["o_orderkey"]).withColumn("last", F.date_add("first", 30)).withColumn("day", F.col("l_shipdate").cast("date"))
    return rows.in_validity(joined, "day", "first", "last", "l_extendedprice").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT c_custkey, strftime(DATE '2025-01-01' + CAST(c_custkey % 300 AS INTEGER), '%m/%d/%y') AS data_inicio, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 90 AS INTEGER) END AS dias_antes_automacao, DATE '2025-01-01' + CAST(c_custkey % 300 AS INTEGER) AS data_inicio_automacao,
CASE WHEN c_custkey % 5 <> 0 THEN DATE '2025-01-01' + CAST(c_custkey % 300 AS INTEGER) - CAST(c_custkey % 90 + 1 AS INTEGER) END AS data_instalacao FROM customer""")
def unit_preparation(spark, sf_dir):
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int"))
    units = table(spark, sf_dir, "customer").select("c_custkey", F.date_format(day, "MM/dd/yy").alias("data_inicio"), F.when(F.col("c_custkey") % 5 != 0, (F.col("c_custkey") % 90).cast("int")).alias("dias_antes_automacao"))
    return consolidate.prepared_units(units)


@query("""WITH k AS (SELECT c_mktsegment AS unit_name, min(c_nationkey) AS reference_id FROM customer GROUP BY 1), u AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'none' ELSE c_mktsegment END AS unit_name FROM customer), i AS (SELECT n_nationkey AS r, n_regionkey AS id FROM nation)
SELECT u.c_custkey, u.unit_name, CAST(k.reference_id AS BIGINT) AS reference_id, i.id AS unit_id FROM u LEFT JOIN k USING (unit_name) LEFT JOIN i ON i.r = k.reference_id""")
def unit_identifiers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    units = c.select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, "none").otherwise(F.col("c_mktsegment")).alias("unit_name"))
    known = c.select(F.col("c_mktsegment").alias("unit_name"), F.col("c_nationkey").alias("reference_id"))
    ids = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("reference_id"), F.col("n_regionkey").alias("id"))
    return consolidate.with_unit_id(consolidate.with_reference(units, known), ids).select("c_custkey", "unit_name", "reference_id", "unit_id")


# scalar and date functions ------------------------------------------------------------------

_MD = "(month(d) * 100 + day(d))"


@query(f"""WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey, CASE WHEN {_MD} >= 1221 OR {_MD} <= 320 THEN 'verao' WHEN {_MD} BETWEEN 321 AND 620 THEN 'outono' WHEN {_MD} BETWEEN 621 AND 922 THEN 'inverno' ELSE 'primavera' END AS estacao,
CASE WHEN month(d) IN (12, 1, 2) THEN 'verao' WHEN month(d) BETWEEN 3 AND 5 THEN 'outono' WHEN month(d) BETWEEN 6 AND 8 THEN 'inverno' ELSE 'primavera' END AS estacao_mes FROM t""")
def seasons(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return enrich.with_season(o, "d").select("o_orderkey", "estacao", dates.season_of_month(F.month("d")).alias("estacao_mes"))


_EASTER = ["1995-04-14", "1996-04-05", "1997-03-28", "1998-04-10", "1999-04-02", "2000-04-21", "2001-04-13", "2002-03-29"]


@query(f"""WITH h AS (SELECT make_date(y, m, d) AS day FROM generate_series(1995, 2002) g(y), (VALUES (1, 1), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (12, 25)) f(m, d) UNION SELECT unnest([{", ".join(f"DATE '{d}'" for d in _EASTER)}])),
t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders), f AS (SELECT *, CAST(d IN (SELECT day FROM h) AS INTEGER) AS feriado, CAST(d IN (SELECT day - 1 FROM h) AS INTEGER) AS vespera_feriado, CAST(isodow(d) AS INTEGER) AS dia_semana FROM t)
SELECT o_orderkey, CAST(month(d) AS INTEGER) AS mes, CAST(quarter(d) AS INTEGER) AS trimestre, dia_semana, feriado, vespera_feriado, CASE WHEN dia_semana <= 5 AND feriado = 0 THEN 1 ELSE 0 END AS dia_util FROM f""")
def calendar_features(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return dates.with_calendar(o, "d").drop("d")


@query(f"""WITH {TELEMETRY} SELECT event_id, CASE WHEN hora <= 6 THEN 'Madrugada' WHEN hora <= 11 THEN 'Manhã' WHEN hora <= 18 THEN 'Tarde' ELSE 'Noite' END AS periodo_dia, CASE WHEN hora <= 6 THEN 0 WHEN hora <= 11 THEN 1 WHEN hora <= 18 THEN 2 ELSE 3 END AS periodo_id FROM tel""")
def day_periods(spark, sf_dir):
    return telemetry(spark, sf_dir).select("event_id", dates.period("hora").alias("periodo_dia"), dates.period_id("hora").alias("periodo_id"))


@query(f"""WITH {TELEMETRY} SELECT event_id, CASE trim(machine_type) WHEN 'splitao' THEN 'SPLITÃO' WHEN 'Split-Wall' THEN 'SPLIT HI-WALL' WHEN 'self' THEN 'SPLITÃO SELF CONTAINED' WHEN 'piso-teto' THEN 'SPLIT PISO-TETO' ELSE 'DESCONHECIDO' END AS tipo_maquina FROM tel""")
def machine_types(spark, sf_dir):
    return telemetry(spark, sf_dir).select("event_id", machines.machine_type("machine_type").alias("tipo_maquina"))


@query("""SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, lower(event_type) AS low, upper(replace(event_type, 'i', '-')) AS up, string_split(event_type, 'i')[2] AS second, regexp_replace('a/b ' || event_type, '[/ ]', '_', 'g') AS name,
round(sin(extract(hour FROM ts) * (2.0 * 3.141592653589793 / 24)), 9) + 0.0 AS s, round(cos(extract(hour FROM ts) * (2.0 * 3.141592653589793 / 24)), 9) + 0.0 AS c, least(greatest(value, 10.0), 100.0) AS clipped, round((least(greatest(value, 10.0), 100.0) - 10) / 90, 9) AS scaled FROM events""")
def scalar_functions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    sine, cosine = scalars.cyclical(F.hour("ts"), 24)
    return e.select(
        "event_id", scalars.number(scalars.json_scalar("props", "k")).alias("k"), F.lower("event_type").alias("low"), F.upper(F.replace("event_type", F.lit("i"), F.lit("-"))).alias("up"), scalars.piece("event_type", "i", 1).alias("second"),
        scalars.safe_name(F.concat(F.lit("a/b "), F.col("event_type"))).alias("name"), F.round(sine, 9).alias("s"), F.round(cosine, 9).alias("c"), scalars.clip("value", 10.0, 100.0).alias("clipped"), F.round(scalars.min_max("value", 10.0, 100.0), 9).alias("scaled"),
    )


@query(f"""WITH {TELEMETRY} SELECT event_id, upper(replace(replace(machine_type, '-', ' '), '_', ' ')) AS override_key, data + to_hours(CAST(hora AS INTEGER)) AS stamp, lag(data + to_hours(CAST(hora AS INTEGER))) OVER o + INTERVAL 1 HOUR = data + to_hours(CAST(hora AS INTEGER)) AS follows FROM tel WINDOW o AS (PARTITION BY unit_id ORDER BY ts, event_id)""")
def hours_and_keys(spark, sf_dir):
    stamp = scalars.hour_stamp("data", "hora")
    before = F.lag("stamp").over(Window.partitionBy("unit_id").orderBy("ts", "event_id"))
    t = telemetry(spark, sf_dir).withColumn("stamp", stamp)
    return t.select("event_id", scalars.override_key("machine_type").alias("override_key"), "stamp", (F.timestamp_add("HOUR", F.lit(1), before) == F.col("stamp")).alias("follows"))


@query("""SELECT kind, round(CAST(sum(v) AS DOUBLE), 2) AS total, count(*) AS n FROM (SELECT 'number' AS kind, CAST(o_custkey AS DOUBLE) AS v FROM orders UNION ALL SELECT 'number', o_totalprice FROM orders UNION ALL SELECT 'text', length(o_orderstatus) FROM orders UNION ALL SELECT 'text', length(o_orderpriority) FROM orders) GROUP BY 1""")
def columns_by_type(spark, sf_dir):
    """The numeric columns of a table summed, the text columns by their lengths, each chosen by type."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    chosen = {"number": [F.col(c).cast("double") for c in rows.numeric_columns(o)], "text": [F.length(c).cast("double") for c in rows.text_columns(o)]}
    one = o.select(F.explode(F.concat(*[F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("v")) for v in values]) for k, values in chosen.items()])).alias("_r")).select("_r.*")
    return one.groupBy("kind").agg(F.round(F.sum("v"), 2).alias("total"), F.count("*").alias("n"))


@query(f"WITH {TELEMETRY} SELECT event_id, machine_type, CAST(hora AS INTEGER) AS hora FROM tel")
def routed_names(spark, sf_dir):
    """A variant of a column's name is routed to the wanted one; where that is there already, nothing changes."""
    t = telemetry(spark, sf_dir).select("event_id", F.col("machine_type").alias("tipo_maquina"), F.col("hora").cast("int").alias("hora"))
    return rows.named(rows.named(t, {"tipo_maquina": "machine_type"}), {"hora": "machine_type"})


@query("SELECT c_custkey AS k, CAST(c_nationkey AS DOUBLE) AS v FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def relaxed_union(spark, sf_dir):
    """Columns of unlike types meet in their common supertype; names decide, not places."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("k"), F.col("c_nationkey").alias("v"))
    return associations.union_all(c, table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("v"), F.col("s_suppkey").cast("bigint").alias("k")))


# outliers -----------------------------------------------------------------------------------

def _rank(q: str) -> str:
    return f"min(CASE WHEN rk > floor({q} * (n - 1) + 0.5) THEN v END)"


_LINE = """ln AS (SELECT CASE WHEN l_linenumber = 7 THEN 'DESCONHECIDO' WHEN l_returnflag = 'A' THEN 'SPLIT HI-WALL' WHEN l_returnflag = 'N' THEN 'SPLITÃO INVERTER' ELSE 'SPLITÃO' END AS seg,
CASE l_returnflag WHEN 'A' THEN l_extendedprice * l_extendedprice / 100000.0 ELSE l_extendedprice END AS v FROM lineitem)"""
_LIMITS = f"""{_LINE}, rk AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY v) AS rk, count(*) OVER (PARTITION BY seg) AS n FROM ln),
q AS (SELECT seg, max(n) AS n, {_rank('0.10')} AS q10, {_rank('0.25')} AS q1, {_rank('0.50')} AS q50, {_rank('0.75')} AS q3, {_rank('0.90')} AS q90, {_rank('0.99')} AS q99 FROM rk GROUP BY seg),
s AS (SELECT *, greatest(q90 - q50, 1e-9) AS mid, greatest(q50 - q10, 1e-9) AS low, greatest(q90 - q10, 1e-9) AS tot FROM q), s2 AS (SELECT *, greatest(q99 - q90, 0) / mid AS tail FROM s),
s3 AS (SELECT *, CASE WHEN seg LIKE '%HI-WALL%' THEN 0.12 WHEN seg LIKE '%INVERTER%' THEN 0.09 ELSE 0.10 END AS qn0, CASE WHEN seg LIKE '%HI-WALL%' THEN 1.5 * 0.9 ELSE 1.5 END AS k0 FROM s2),
s4 AS (SELECT *, CASE WHEN tot <= 0.35 * greatest(q50, 1e-6) AND mid / low < 1.8 THEN least(qn0 + 0.02, 0.20) ELSE qn0 END AS qn1, CASE WHEN tail >= 1.5 THEN least(k0, 1.25) WHEN tail >= 1.0 THEN least(k0, 1.40) WHEN tail >= 0.6 THEN least(k0, 1.60) ELSE k0 END AS k1 FROM s3),
s5 AS (SELECT *, CASE WHEN seg = 'SPLITÃO' THEN 0.25 ELSE qn1 END AS qn, CASE WHEN seg = 'SPLITÃO' THEN 2.0 WHEN seg = 'DESCONHECIDO' THEN 0.1 ELSE k1 END AS k, CASE WHEN seg = 'SPLITÃO' THEN NULL ELSE 0.90 END AS qc, CASE WHEN seg = 'DESCONHECIDO' THEN 0.0 ELSE 100.0 END AS base FROM s4),
a AS (SELECT seg, min(CASE WHEN rk > floor(qn * (rk.n - 1) + 0.5) THEN v END) AS vn, min(CASE WHEN rk > floor(qc * (rk.n - 1) + 0.5) THEN v END) AS vc FROM rk JOIN s5 USING (seg) GROUP BY seg),
f AS (SELECT s5.*, vc, CASE WHEN base > 0 THEN least(greatest(vn, base), 4 * base) ELSE greatest(vn, 0) END AS noise_floor FROM s5 JOIN a USING (seg)),
lim AS (SELECT seg, n AS n_before, noise_floor, q1, q3, tail, k, qn, greatest(q1 - k * (q3 - q1), noise_floor) AS lo, least(q3 + k * (q3 - q1), coalesce(vc, q3 + k * (q3 - q1))) AS hi FROM f)"""


def _segments(spark, sf_dir):
    flag, v = F.col("l_returnflag"), F.col("l_extendedprice")
    seg = F.when(F.col("l_linenumber") == 7, F.when(F.col("l_orderkey") % 2 == 0, " ")).when(flag == "A", "SPLIT HI-WALL").when(flag == "N", "SPLITÃO INVERTER").otherwise("SPLITÃO")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", seg.alias("seg"), F.when(flag == "A", v * v / 100000.0).otherwise(v).alias("v"))


def _limits(spark, sf_dir):
    """The limits of segments, two of them overridden: bounded settings, a fence without a cap, and no floor."""
    rows = [("splitão", None, 2.0, 0.5, True), ("desconhecido", -5.0, 0.01, None, False)]
    given = spark.createDataFrame(rows, "segment string, noise_floor double, iqr_factor double, noise_quantile double, no_upper_cap boolean")
    settings = outliers.Settings(noise_floor=100.0, iqr_factor=1.5, min_segment_size=50, noise_quantile=0.10, upper_quantile_cap=0.90)
    return outliers.thresholds(_segments(spark, sf_dir), "seg", "v", settings, given)


@query(f"WITH {_LIMITS} SELECT seg, n_before, round(noise_floor, 6) AS noise_floor, round(q1, 6) AS q1, round(q3, 6) AS q3, round(tail, 6) AS tail_ratio, round(CAST(k AS DOUBLE), 6) AS iqr_factor_used, round(CAST(qn AS DOUBLE), 6) AS noise_quantile_used, round(lo, 6) AS lo, round(greatest(hi, lo), 6) AS hi FROM lim")
def outlier_thresholds(spark, sf_dir):
    return _limits(spark, sf_dir).select("seg", "n_before", *[F.round(c, 6).alias(c) for c in ("noise_floor", "q1", "q3", "tail_ratio", "iqr_factor_used", "noise_quantile_used", "lo", "hi")])


_ACCOUNT = f"""{_LIMITS}, r AS (SELECT seg, v, v BETWEEN lo AND greatest(hi, lo) AS kept, noise_floor AS f FROM ln JOIN lim USING (seg)),
acc AS (SELECT seg, count(*) AS n_before, count(*) FILTER (v < f) AS n_noise, count(*) FILTER (NOT kept AND v >= f) AS n_extreme, count(*) FILTER (kept) AS n_after, round(min(v) FILTER (kept), 6) AS kept_min, round(max(v) FILTER (kept), 6) AS kept_max, round(100.0 * (count(*) - count(*) FILTER (kept)) / count(*), 4) AS pct_removed FROM r GROUP BY seg)"""


@query(f"WITH {_ACCOUNT} SELECT * FROM acc")
def outlier_accounting(spark, sf_dir):
    out = outliers.accounting(_segments(spark, sf_dir), _limits(spark, sf_dir), "seg", "v")
    return out.withColumns({c: F.round(c, 6) for c in ("kept_min", "kept_max")})


@query(f"WITH {_ACCOUNT}, t AS (SELECT CAST(sum(n_before) AS BIGINT) AS n_before, CAST(sum(n_noise) AS BIGINT) AS n_noise, CAST(sum(n_extreme) AS BIGINT) AS n_extreme, CAST(sum(n_after) AS BIGINT) AS n_after FROM acc) SELECT *, n_before - n_after AS n_removed, round(100.0 * (n_before - n_after) / n_before, 4) AS pct_removed FROM t")
def outlier_totals(spark, sf_dir):
    return outliers.totals(outliers.accounting(_segments(spark, sf_dir), _limits(spark, sf_dir), "seg", "v"))


@query(f"""WITH {_LIMITS}, b AS (SELECT seg, count(*) AS n_before FROM ln GROUP BY seg), k AS (SELECT seg, count(*) AS n FROM ln JOIN lim USING (seg) WHERE v BETWEEN lo AND greatest(hi, lo) GROUP BY seg)
SELECT seg, n_before, coalesce(n, 0) AS n_after, n_before - coalesce(n, 0) AS removed, round(100.0 * (n_before - coalesce(n, 0)) / n_before, 4) AS pct FROM b LEFT JOIN k USING (seg)""")
def outlier_impact(spark, sf_dir):
    df = _segments(spark, sf_dir)
    return outliers.impact(df, outliers.filtered(df, _limits(spark, sf_dir), "seg", "v"), "seg")


@query(f"WITH {_LINE}, rk AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY v) AS rk, count(*) OVER (PARTITION BY seg) AS n FROM ln) SELECT seg, max(n) AS n, {_rank('0.05')} AS q05, {_rank('0.5')} AS q50, quantile_cont(v, 0.5) AS l50 FROM rk GROUP BY seg")
def segment_quantiles(spark, sf_dir):
    df = rows.segmented(_segments(spark, sf_dir), "seg")
    return quantiles.nearest(df, "v", {"q05": 0.05, "q50": 0.5}, ["seg"]).join(quantiles.linear(df, "v", {"l50": 0.5}, ["seg"]).drop("n"), "seg")


# encoders -----------------------------------------------------------------------------------

@query("WITH f AS (SELECT p_type AS value, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS idx FROM (SELECT DISTINCT p_type FROM part WHERE p_size < 30)) SELECT p_partkey, coalesce(idx, -1) AS p_type_idx FROM part LEFT JOIN f ON value = p_type")
def index_encoding(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return encoders.apply_index(p, encoders.fit_index(p.filter("p_size < 30"), "p_type"), "p_type").select("p_partkey", "p_type_idx")


@query("SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'A' AS INTEGER) AS \"l_returnflag_A\", CAST(l_returnflag = 'N' AS INTEGER) AS \"l_returnflag_N\", CAST(l_returnflag = 'R' AS INTEGER) AS \"l_returnflag_R\" FROM lineitem")
def one_hot(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return encoders.one_hot(line.select("l_orderkey", "l_linenumber", "l_returnflag"), {"l_returnflag": encoders.vocabulary(line, "l_returnflag")})


_CLIP = "WITH r AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS rk, count(*) OVER () AS n FROM lineitem), q AS (SELECT {a} AS q1, {b} AS q3 FROM r), lim AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)".format(a=_rank("0.15"), b=_rank("0.85"))


@query(f"{_CLIP} SELECT 'l_extendedprice' AS column, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, round(lower, 6) AS lower, round(upper, 6) AS upper FROM lim")
def clip_limits(spark, sf_dir):
    return encoders.fit_clip(table(spark, sf_dir, "lineitem"), ["l_extendedprice"]).select("column", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "iqr", "lower", "upper")])


@query(f"{_CLIP} SELECT l_orderkey, l_linenumber, round((least(greatest(l_extendedprice, lower), upper) - lower) / (upper - lower), 9) AS scaled FROM lineitem, lim")
def clip_min_max(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return encoders.apply_clip(line, encoders.fit_clip(line, ["l_extendedprice"])).select("l_orderkey", "l_linenumber", F.round("l_extendedprice", 9).alias("scaled"))


@query("""WITH f AS (SELECT l_linenumber AS v, avg(l_quantity) AS m, count(*) AS k FROM lineitem WHERE l_linenumber < 6 GROUP BY 1), g AS (SELECT avg(l_quantity) AS g FROM lineitem WHERE l_linenumber < 6)
SELECT l_orderkey, l_linenumber AS line, round(coalesce((k * m + 10 * g) / (k + 10), g), 9) AS l_linenumber_target_enc FROM lineitem CROSS JOIN g LEFT JOIN f ON v = l_linenumber""")
def target_encoding(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_linenumber").alias("line"))
    fitted = encoders.fit_target(line.filter("l_linenumber < 6"), "l_linenumber", "l_quantity")
    return encoders.apply_target(line, fitted, "l_linenumber").select("l_orderkey", "line", F.round("l_linenumber_target_enc", 9).alias("l_linenumber_target_enc"))


@query("SELECT event_id, round(sin(extract(hour FROM ts) * (2.0 * 3.141592653589793 / 24)), 9) + 0.0 AS hora_sin, round(cos(extract(hour FROM ts) * (2.0 * 3.141592653589793 / 24)), 9) + 0.0 AS hora_cos FROM events")
def cyclical_encoding(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.hour("ts").alias("hora"))
    return encoders.with_cycle(e, "hora", 24).select("event_id", F.round("hora_sin", 9).alias("hora_sin"), F.round("hora_cos", 9).alias("hora_cos"))


@query("SELECT o_orderkey, CAST(o_totalprice AS FLOAT) AS o_totalprice, CAST(0 AS FLOAT) AS absent, CAST(o_custkey AS FLOAT) AS o_custkey, CAST(0 AS DOUBLE) AS target FROM orders")
def aligned_matrix(spark, sf_dir):
    return rows.with_target(rows.aligned(table(spark, sf_dir, "orders"), ["o_totalprice", "absent", "o_custkey"], ["o_orderkey"]), "target")


@query("SELECT CAST(max(l_linenumber) + 1 AS BIGINT) AS l_linenumber, CAST(max(l_suppkey) + 1 AS BIGINT) AS l_suppkey FROM lineitem")
def index_sizes(spark, sf_dir):
    return encoders.index_sizes(table(spark, sf_dir, "lineitem"), ["l_linenumber", "l_suppkey"])


@query("SELECT count(*) FILTER (l_linenumber >= 5) AS l_linenumber_out, count(*) FILTER (l_suppkey >= 50) AS l_suppkey_out, count(*) FILTER (l_linenumber < 5 AND l_suppkey < 50) AS n_valid FROM lineitem")
def index_bounds(spark, sf_dir):
    return encoders.out_of_bounds(table(spark, sf_dir, "lineitem"), {"l_linenumber": 5, "l_suppkey": 50})


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END AS ratio FROM lineitem")
def sanitised(spark, sf_dir):
    ratio = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_tax", "l_discount"))
    return encoders.sanitised(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ratio.alias("ratio")))


@query("""SELECT * FROM (SELECT 'l_discount' AS column, round(avg(l_discount), 9) AS mean, round(stddev_pop(l_discount), 9) AS std, min(l_discount) AS min, max(l_discount) AS max FROM lineitem UNION ALL SELECT 'l_quantity', round(avg(l_quantity), 9), round(stddev_pop(l_quantity), 9), min(l_quantity), max(l_quantity) FROM lineitem)""")
def normalisation_stats(spark, sf_dir):
    s = encoders.normalisation(table(spark, sf_dir, "lineitem"), ["l_discount", "l_quantity"])
    return s.withColumn("mean", F.round("mean", 9)).withColumn("std", F.round("std", 9))


@query("""SELECT 'l_discount' AS column, min(l_discount) AS min, max(l_discount) AS max, CAST(0 AS BIGINT) AS n_nan, count(DISTINCT l_discount) AS n_distinct, count(*) FILTER (l_discount > 1) AS n_out, '' AS warning FROM lineitem
UNION ALL SELECT 'l_quantity', min(l_quantity), max(l_quantity), 0, count(DISTINCT l_quantity), count(*) FILTER (l_quantity > 1 OR l_quantity < 0), 'out of bounds' FROM lineitem""")
def matrix_inspection(spark, sf_dir):
    return profile.inspected(table(spark, sf_dir, "lineitem"), ["l_discount", "l_quantity"])


# features -----------------------------------------------------------------------------------

_KINDS = ["DESCONHECIDO", "SPLIT HI-WALL", "SPLIT PISO-TETO", "SPLITÃO", "SPLITÃO SELF CONTAINED"]
_TIMES = ["Madrugada", "Manhã", "Noite", "Tarde"]
_NEW_YEAR = "DATE '2024-01-01'"  # the only holiday within the events; 31 December, an eve, is before them
_TRAINED = "event_id % 4 <> 0"
_READY = f"""{OBSERVED}, rd AS (SELECT *, CAST(month(data) AS INTEGER) AS mes, 1 AS trimestre, CAST(data = {_NEW_YEAR} AS INTEGER) AS is_feriado, CAST(data = DATE '2023-12-31' AS INTEGER) AS is_vespera_feriado, CAST(isodow(data) <= 5 AND data <> {_NEW_YEAR} AS INTEGER) AS is_dia_util,
CASE WHEN hora <= 6 THEN 'Madrugada' WHEN hora <= 11 THEN 'Manhã' WHEN hora <= 18 THEN 'Tarde' ELSE 'Noite' END AS periodo_dia, CASE WHEN hora <= 6 THEN 0 WHEN hora <= 11 THEN 1 WHEN hora <= 18 THEN 2 ELSE 3 END AS periodo_id,
CASE trim(machine_type) WHEN 'splitao' THEN 'SPLITÃO' WHEN 'Split-Wall' THEN 'SPLIT HI-WALL' WHEN 'self' THEN 'SPLITÃO SELF CONTAINED' WHEN 'piso-teto' THEN 'SPLIT PISO-TETO' ELSE 'DESCONHECIDO' END AS tipo_maquina FROM obs),
full_rows AS (SELECT * FROM rd WHERE {' AND '.join(f'"{c}" IS NOT NULL' for c in features.MEASURED)}),
tr AS (SELECT * FROM full_rows WHERE {_TRAINED})"""
_LEARNED = f"""{_READY}, gm AS (SELECT avg(consumo_kwh) AS g FROM tr), te AS (SELECT hora, (count(*) * avg(consumo_kwh) + 10 * any_value(g)) / (count(*) + 10) AS enc FROM tr, gm GROUP BY 1), te2 AS (SELECT mes, (count(*) * avg(consumo_kwh) + 10 * any_value(g)) / (count(*) + 10) AS enc2 FROM tr, gm GROUP BY 1),
ix AS (SELECT grupo_regional, CAST(row_number() OVER (ORDER BY CAST(grupo_regional AS VARCHAR)) - 1 AS INTEGER) AS gi FROM (SELECT DISTINCT grupo_regional FROM tr)),
""" + ", ".join(f"""l{i} AS (SELECT q1 - 1.5 * (q3 - q1) AS a{i}, q3 + 1.5 * (q3 - q1) AS b{i} FROM (SELECT {_rank('0.15')} AS q1, {_rank('0.85')} AS q3 FROM (SELECT "{c}" AS v, row_number() OVER (ORDER BY "{c}") AS rk, count(*) OVER () AS n FROM tr)))""" for i, c in enumerate(features.MEASURED)) + """, lim AS (SELECT * FROM """ + ", ".join(f"l{i}" for i in range(len(features.MEASURED))) + ")"
_SCALED = ", ".join(f'round(((least(greatest("{c}", a{i}), b{i}) - a{i}) / (b{i} - a{i}))::FLOAT::DOUBLE, 5) AS "{c}"' for i, c in enumerate(features.MEASURED))
_DUMMIES = ", ".join(f"CAST({c} = '{v}' AS INTEGER) AS \"{c}_{v}\"" for c, values in (("tipo_maquina", _KINDS), ("estacao", ["verao"]), ("periodo_dia", _TIMES)) for v in values)
_MATRIX = f"""SELECT event_id, gi AS grupo_regional, {_SCALED}, trimestre, is_feriado, is_vespera_feriado, is_dia_util, {_DUMMIES}, round(coalesce(enc, g)::FLOAT::DOUBLE, 5) AS hora_target_enc, round(coalesce(enc2, g)::FLOAT::DOUBLE, 5) AS mes_target_enc"""


def _plain(df):
    """Floats of a feature table as whole numbers, or rounded doubles."""
    whole = ("grupo_regional", *features.CALENDAR)
    kind = lambda c: F.col(f"`{c}`").cast("int") if c in whole or c.startswith(("tipo_maquina_", "estacao_", "periodo_dia_")) else F.round(F.col(f"`{c}`").cast("double"), 5)
    return df.select("event_id", *[kind(c).alias(c) for c in df.columns if c != "event_id"])


def _reloaded(spark, sf_dir):
    """What is fitted on the training rows, written to the shared folder and read again."""
    path = f"{shared_folder(spark)}/features-{uuid.uuid4().hex}"
    features.save(features.fit(views.observations(spark, sf_dir).filter("event_id % 4 <> 0")), path)
    return features.load(spark, path)


@query(f"WITH {_READY} SELECT event_id, grupo_regional, hora, mes, trimestre, is_feriado, is_vespera_feriado, is_dia_util, {_DUMMIES} FROM full_rows")
def feature_build(spark, sf_dir):
    return features.built(views.observations(spark, sf_dir)).drop("consumo_kwh", *features.MEASURED)


@query(f"WITH {_LEARNED} {_MATRIX} FROM tr LEFT JOIN te USING (hora) LEFT JOIN te2 USING (mes) LEFT JOIN ix USING (grupo_regional), gm, lim")
def training_matrix(spark, sf_dir):
    df = views.observations(spark, sf_dir).filter("event_id % 4 <> 0")
    fitted = features.fit(df)
    return _plain(features.apply(features.prepared(df, fitted.settings), fitted, ["event_id"]))


@query(f"""WITH {_LEARNED}, sc AS (SELECT * FROM full_rows WHERE NOT ({_TRAINED})) {_MATRIX} FROM sc LEFT JOIN te USING (hora) LEFT JOIN te2 USING (mes) LEFT JOIN ix USING (grupo_regional), gm, lim""")
def inference_features(spark, sf_dir):
    df = views.observations(spark, sf_dir).filter("event_id % 4 = 0 and Temperatura_C is not null").drop("consumo_kwh", "estacao").withColumnRenamed("machine_type", "tipo_maquina")
    return _plain(features.scored(df, _reloaded(spark, sf_dir), keys=["event_id"]))


@query(f"""WITH {_LEARNED}, sc AS (SELECT * FROM full_rows WHERE NOT ({_TRAINED})) SELECT event_id, CAST(hora AS INTEGER) AS hora, mes, grupo_regional, periodo_id AS periodo_dia, round(least(greatest("Temperatura_C", a0), b0) - a0, 3) AS first_offset,
CAST(is_dia_util AS INTEGER) AS is_dia_util, CAST({len(features.MEASURED) + 4 + len(_KINDS) + 1} AS INTEGER) AS n_dense, hora < 22 AND grupo_regional < 4 AS valid FROM sc, lim""")
def dense_inputs(spark, sf_dir):
    df = views.observations(spark, sf_dir).filter("event_id % 4 = 0 and Temperatura_C is not null").drop("consumo_kwh", "estacao")
    fitted = _reloaded(spark, sf_dir)
    made = features.dense_inputs(df, fitted, {"hora": 22, "mes": 13, "grupo_regional": 4, "periodo_dia": 4}, keys=["event_id"])
    # the fitted limits give the first measure back its unit, so that rounding is of numbers of one size
    wide = fitted.limits.filter("column = 'Temperatura_C'").select((F.col("upper") - F.col("lower")).alias("wide"))
    flag = len(features.MEASURED) + features.CALENDAR.index("is_dia_util")
    return made.crossJoin(F.broadcast(wide)).select("event_id", *features.INDEXED, F.round(made["dense"][0].cast("double") * F.col("wide"), 3).alias("first_offset"), made["dense"][flag].cast("int").alias("is_dia_util"), F.size("dense").alias("n_dense"), "valid")


# geography ----------------------------------------------------------------------------------

_KM = "2 * 6371.0::DOUBLE * asin(least(sqrt(pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)), 1.0))"
_GROUPS = f"""{POINTS}, e AS (SELECT a.latitude AS alat, a.longitude AS alon, b.latitude AS blat, b.longitude AS blon FROM pts a JOIN pts b ON {_KM} <= 250),
reach AS (SELECT alat, alon, blat, blon FROM e UNION SELECT r.alat, r.alon, e.blat, e.blon FROM reach r JOIN e ON e.alat = r.blat AND e.alon = r.blon),
root AS (SELECT alat AS latitude, alon AS longitude, min({{'lat': blat, 'lon': blon}}) AS root, count(*) AS n FROM reach GROUP BY 1, 2),
num AS (SELECT root, CAST(row_number() OVER (ORDER BY CASE WHEN max(n) = 1 THEN 1 ELSE 0 END, root) - 1 AS INTEGER) AS grupo_regional FROM root GROUP BY root),
grp AS (SELECT latitude, longitude, grupo_regional FROM root JOIN num USING (root))"""


@query(f"WITH RECURSIVE {_GROUPS} SELECT * FROM grp")
def geographic_clusters(spark, sf_dir):
    return geo.clusters(views.points(spark, sf_dir), 250.0, 2).drop("is_core")


@query(f"WITH RECURSIVE {_GROUPS} SELECT latitude, longitude, grupo_regional FROM grp")
def mapping_export(spark, sf_dir):
    path = f"{shared_folder(spark)}/groups-{uuid.uuid4().hex}"
    geo.save_mapping(geo.clusters(views.points(spark, sf_dir), 250.0, 2), path)
    return geo.load_mapping(spark, path)


@query(f"WITH {POINTS} SELECT a.latitude AS lat_a, a.longitude AS lon_a, b.latitude AS lat_b, b.longitude AS lon_b, round({_KM}, 6) AS km FROM pts a JOIN pts b ON (a.latitude <> b.latitude OR a.longitude <> b.longitude) AND {_KM} <= 150")
def radius_neighbours(spark, sf_dir):
    return geo.neighbours(geo.coordinates(views.points(spark, sf_dir)), 150.0).withColumn("km", F.round("km", 6))


@query(f"WITH RECURSIVE {_GROUPS} SELECT grupo_regional, round(avg(latitude), 9) AS lat_media, round(avg(longitude), 9) AS lon_media, count(*) AS n_pontos, count(*) = 1 AS is_isolado FROM grp GROUP BY 1")
def cluster_summary(spark, sf_dir):
    s = geo.summary(geo.clusters(views.points(spark, sf_dir), 250.0, 2))
    return s.withColumn("lat_media", F.round("lat_media", 9)).withColumn("lon_media", F.round("lon_media", 9))


_PLACED = "c AS (SELECT c_custkey, CASE WHEN c_custkey % 13 <> 0 THEN -33.0::DOUBLE + (c_custkey * 7919 % 2800)::DOUBLE / 100::DOUBLE END AS latitude, -60.0::DOUBLE + (c_custkey * 104729 % 2500)::DOUBLE / 100::DOUBLE AS longitude FROM customer), ref AS (SELECT latitude, longitude, min(s_suppkey) AS g FROM (SELECT s_suppkey, -33.0::DOUBLE + (s_suppkey * 7919 % 2800)::DOUBLE / 100::DOUBLE AS latitude, -60.0::DOUBLE + (s_suppkey * 104729 % 2500)::DOUBLE / 100::DOUBLE AS longitude FROM supplier) GROUP BY 1, 2)"


@query(f"WITH {_PLACED} SELECT c_custkey, CASE WHEN latitude IS NULL THEN NULL ELSE (SELECT arg_min(b.g, {{'d': round({_KM.replace('a.', 'c.')}, 9), 'lat': b.latitude, 'lon': b.longitude}}) FROM ref b) END AS grupo_regional FROM c")
def nearest_group(spark, sf_dir):
    key = F.col("c_custkey")
    lat, lon = F.lit(-33.0) + (key * 7919 % 2800).cast("double") / 100.0, F.lit(-60.0) + (key * 104729 % 2500).cast("double") / 100.0
    places = table(spark, sf_dir, "customer").select("c_custkey", F.when(key % 13 != 0, lat).alias("latitude"), lon.alias("longitude"))
    ref = views.points(spark, sf_dir).groupBy("latitude", "longitude").agg(F.min("s_suppkey").alias("grupo_regional"))
    return geo.assign(places, ref).select("c_custkey", "grupo_regional")


# weather ------------------------------------------------------------------------------------

_KEYS = "SELECT DISTINCT unit_id % 7 AS k, data FROM tel WHERE (unit_id % 7 + day(data)) % 3 <> 0"
_WEATHER = f"""{TELEMETRY}, wx AS (SELECT CAST(k * -1.5 AS DOUBLE) AS latitude, CAST(k * -2.5 AS DOUBLE) AS longitude, data, strftime(data, '%Y-%m-%d') AS data_str, CAST(h AS BIGINT) AS hora, k * 10 + day(data) + h / 2.0 AS t FROM ({_KEYS}), generate_series(0, 23) g(h))"""
_MEASURES = ", ".join(f'CAST(t + {i} AS DOUBLE) AS "{n}"' for i, n in enumerate(weather.MEASURES.values()))


def _responses(spark, sf_dir):
    """A response for two thirds of the places and days of the telemetry: made-up measures by the hour."""
    keys = telemetry(spark, sf_dir).select((F.col("unit_id") % 7).alias("k"), "data").distinct().filter((F.col("k") + F.day("data")) % 3 != 0)
    hours = F.sequence(F.lit(0), F.lit(23))
    time = F.transform(hours, lambda h: F.concat(F.date_format("data", "yyyy-MM-dd"), F.lit("T"), F.lpad(h.cast("string"), 2, "0"), F.lit(":00")))
    more = lambda i: F.transform(hours, lambda h: F.col("k") * 10 + F.day("data") + h / 2.0 + F.lit(float(i)))
    measures = {m: more(i) for i, m in enumerate(weather.MEASURES)}
    body = F.to_json(F.struct(F.struct(time.alias("time"), *[v.alias(m) for m, v in measures.items()]).alias("hourly")))
    return keys.select((F.col("k") * -1.5 + 0.0).alias("latitude"), (F.col("k") * -2.5 + 0.0).alias("longitude"), body.alias("body"))


@query(f"WITH {_WEATHER} SELECT latitude, longitude, data_str, hora, {_MEASURES} FROM wx")
def weather_hours(spark, sf_dir):
    return weather.parse_responses(_responses(spark, sf_dir))


_HERE = f"{_WEATHER}, here AS (SELECT event_id, data, hora, unit_id, consumo_kwh, CAST(unit_id % 7 * -1.5 AS DOUBLE) AS latitude, CAST(unit_id % 7 * -2.5 AS DOUBLE) AS longitude FROM tel)"


def _here(spark, sf_dir):
    k = F.col("unit_id") % 7
    return telemetry(spark, sf_dir).select("event_id", "data", "hora", (k * -1.5 + 0.0).alias("latitude"), (k * -2.5 + 0.0).alias("longitude"))


@query(f'WITH {_HERE} SELECT event_id, CAST(t AS DOUBLE) AS "Temperatura_C", CAST(t + 2 AS DOUBLE) AS "Umidade_Relativa_%" FROM here LEFT JOIN wx USING (latitude, longitude, data, hora)')
def weather_attached(spark, sf_dir):
    return enrich.with_weather(_here(spark, sf_dir), weather.parse_responses(_responses(spark, sf_dir))).select("event_id", "Temperatura_C", "Umidade_Relativa_%")


@query(f"WITH {_HERE} SELECT DISTINCT latitude, longitude, strftime(data, '%Y-%m-%d') AS data_str FROM here WHERE NOT EXISTS (SELECT 1 FROM wx WHERE wx.latitude = here.latitude AND wx.longitude = here.longitude AND wx.data = here.data)")
def weather_missing(spark, sf_dir):
    return enrich.weather_work(_here(spark, sf_dir), weather.parse_responses(_responses(spark, sf_dir)))


@query(f"WITH {_WEATHER} SELECT DISTINCT latitude, longitude, data_str FROM wx")
def weather_cached_keys(spark, sf_dir):
    hours = weather.parse_responses(_responses(spark, sf_dir))
    return weather.cached_keys(weather.extended(hours.filter("hora < 12"), hours))


# places are farther apart than the radius: each is a group, numbered in order of coordinates
_GROUP_HERE = "CAST(dense_rank() OVER (ORDER BY latitude, longitude) - 1 AS INTEGER) AS grupo_regional"


@query(f'WITH {_HERE} SELECT event_id, CASE WHEN {_MD.replace("(d)", "(data)")} >= 1221 OR {_MD.replace("(d)", "(data)")} <= 320 THEN \'verao\' ELSE \'outono\' END AS estacao, {_GROUP_HERE}, CAST(t + 1 AS DOUBLE) AS "Temperatura_Percebida_C", CAST(t + 7 AS DOUBLE) AS "Irradiancia_Difusa_Wm2" FROM here LEFT JOIN wx USING (latitude, longitude, data, hora)')
def enriched_rows(spark, sf_dir):
    df = enrich.enriched(_here(spark, sf_dir), weather.parse_responses(_responses(spark, sf_dir)))
    return df.select("event_id", "estacao", "grupo_regional", "Temperatura_Percebida_C", "Irradiancia_Difusa_Wm2")


@query(f"WITH {_HERE} SELECT event_id, {_GROUP_HERE} FROM here")
def groups_only(spark, sf_dir):
    return enrich.with_groups(_here(spark, sf_dir), radius_km=5.0, min_samples=2).select("event_id", "grupo_regional")


# profile ------------------------------------------------------------------------------------

@query("SELECT p_type AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM part), 9) AS share FROM part GROUP BY 1")
def value_shares(spark, sf_dir):
    return profile.value_shares(table(spark, sf_dir, "part"), "p_type").withColumn("share", F.round("share", 9))


@query("""WITH m AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, count(*) AS t, (max(l_extendedprice) - min(l_extendedprice)) / 10 AS w FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), 9) AS INTEGER) AS bin, count(*) AS n, round(count(*) / max(t), 9) AS share, any_value(lo) AS lo, any_value(w) AS w FROM lineitem, m GROUP BY 1)
SELECT bin, n, share, round(lo + bin * w, 6) AS low, round(lo + (bin + 1) * w, 6) AS high, printf('(%.0f, %.0f)', lo + bin * w, lo + (bin + 1) * w) AS label FROM b""")
def histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice").select("bin", "n", *[F.round(c, d).alias(c) for c, d in (("share", 9), ("low", 6), ("high", 6))], "label")


@query("SELECT count(DISTINCT l_returnflag) AS l_returnflag, count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_linenumber) AS l_linenumber FROM lineitem")
def distinct_counts(spark, sf_dir):
    return profile.distinct_counts(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_suppkey", "l_linenumber"])


@query("""SELECT 'x' AS column, count(*) FILTER (l_tax <= 0.02) AS n_null, round(count(*) FILTER (l_tax <= 0.02) / count(*), 9) AS rate FROM lineitem
UNION ALL SELECT 'y', count(*) FILTER (l_linenumber = 3), round(count(*) FILTER (l_linenumber = 3) / count(*), 9) FROM lineitem""")
def null_rates(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select(F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("x"), F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("y"))
    return profile.null_rates(line, ["x", "y"]).withColumn("rate", F.round("rate", 9))


_MEASURED = ("l_quantity", "l_extendedprice", "l_suppkey", "l_partkey")


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS r FROM lineitem" for i, a in enumerate(_MEASURED) for b in _MEASURED[i:]))
def correlations(spark, sf_dir):
    return profile.correlations(table(spark, sf_dir, "lineitem"), list(_MEASURED)).withColumn("r", F.round("r", 9))


@query("""WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q75 FROM events GROUP BY 1), f AS (SELECT *, q25 - 1.5 * (q75 - q25) AS lower, q75 + 1.5 * (q75 - q25) AS upper FROM q)
SELECT event_type, n, round(q25, 6) AS q25, round(median, 6) AS median, round(q75, 6) AS q75, round(lower, 6) AS lower, round(upper, 6) AS upper, count(*) FILTER (value < lower) AS n_below, count(*) FILTER (value > upper) AS n_above FROM events JOIN f USING (event_type) GROUP BY ALL""")
def box_numbers(spark, sf_dir):
    b = profile.box_numbers(table(spark, sf_dir, "events"), "value", ["event_type"])
    return b.withColumns({c: F.round(c, 6) for c in ("q25", "median", "q75", "lower", "upper")})


@query("SELECT min(value) AS min, max(value) AS max, round(avg(value), 9) AS mean, round(stddev_samp(value), 9) AS std, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75 FROM events")
def target_summary(spark, sf_dir):
    s = profile.target_summary(table(spark, sf_dir, "events"), "value")
    return s.withColumns({"mean": F.round("mean", 9), "std": F.round("std", 9)} | {c: F.round(c, 6) for c in ("q25", "median", "q75")})


@query("SELECT p_type AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def top_segment(spark, sf_dir):
    return profile.share_rank(table(spark, sf_dir, "part"), "p_type")


@query("SELECT count(*) AS n_rows, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM events")
def table_extent(spark, sf_dir):
    return tables.extent(table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date")), "day")


@query("SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_before FROM events")
def value_before(spark, sf_dir):
    return profile.before(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "value").select("event_id", "value_before")


# metrics ------------------------------------------------------------------------------------

_PAIR = "pr AS (SELECT l_returnflag AS segment, l_extendedprice AS y, l_quantity * p_retailprice AS p, l_quantity * 1500.0::DOUBLE AS p2 FROM lineitem JOIN part ON p_partkey = l_partkey)"
_METRICS = "count(*) AS n, round(avg(abs(p - y)), 6) AS \"MAE\", round(sqrt(avg((p - y) * (p - y))), 6) AS \"RMSE\", round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 9) AS \"R2\", round(avg(abs(p - y) / greatest(abs(y), 1e-8) * 100), 6) AS \"MAPE\", round(100 * sum(abs(p - y)) / sum(abs(y)), 6) AS \"WMAPE\", round(100 - avg(abs(p - y) / greatest(abs(y), 1e-8) * 100), 6) AS \"Acuracia\""


def _pairs(spark, sf_dir):
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).select(F.col("l_returnflag").alias("segment"), F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("p"), (F.col("l_quantity") * 1500.0).alias("p2"))


def _rounded(df):
    return df.withColumns({c: F.round(c, 9 if c == "R2" else 6) for c in metrics.NAMES})


@query(f"WITH {_PAIR} SELECT {_METRICS} FROM pr")
def error_metrics(spark, sf_dir):
    return _rounded(metrics.error_metrics(_pairs(spark, sf_dir), "y", "p"))


@query(f"WITH {_PAIR} SELECT segment, {_METRICS} FROM pr GROUP BY 1")
def metrics_by_segment(spark, sf_dir):
    return _rounded(metrics.error_metrics(_pairs(spark, sf_dir), "y", "p", ["segment"]))


@query(f"WITH {_PAIR}, s AS (SELECT segment, count(*) AS n, avg(abs(p - y)) AS a, avg(abs(p - y) / greatest(abs(y), 1e-8) * 100) AS b FROM pr GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS n_test, round(sum(a * n) / sum(n), 6) AS \"MAE\", round(sum(b * n) / sum(n), 6) AS \"MAPE\" FROM s")
def weighted_report(spark, sf_dir):
    per = metrics.error_metrics(_pairs(spark, sf_dir), "y", "p", ["segment"]).withColumnRenamed("n", "n_test")
    return metrics.weighted(per, ["MAE", "MAPE"]).withColumns({c: F.round(c, 6) for c in ("MAE", "MAPE")})


@query(f"WITH {_PAIR}, g AS (SELECT segment, abs(p - y) / greatest(abs(y), 1e-8) * 100 AS a, abs(p2 - y) / greatest(abs(y), 1e-8) * 100 AS b FROM pr) SELECT segment, CASE WHEN b < a THEN 'challenger' WHEN a < b THEN 'champion' ELSE 'tie' END AS winner, count(*) AS n, round(avg(a - b), 6) AS mean_gain FROM g GROUP BY 1, 2")
def champion_tally(spark, sf_dir):
    return metrics.tally(_pairs(spark, sf_dir), "y", "p", "p2", ["segment"]).withColumn("mean_gain", F.round("mean_gain", 6))


@query(f"WITH {_PAIR}, m AS (SELECT 'part' AS model, segment, avg(abs(p - y) / greatest(abs(y), 1e-8) * 100) AS e FROM pr GROUP BY 2 UNION ALL SELECT 'flat', segment, avg(abs(p2 - y) / greatest(abs(y), 1e-8) * 100) FROM pr GROUP BY 2) SELECT model, segment, round(e, 6) AS \"MAPE\", CAST(row_number() OVER (PARTITION BY segment ORDER BY e, model) AS INTEGER) AS rank FROM m")
def model_ranking(spark, sf_dir):
    df = _pairs(spark, sf_dir)
    both = metrics.error_metrics(df, "y", "p", ["segment"]).withColumn("model", F.lit("part")).unionByName(metrics.error_metrics(df, "y", "p2", ["segment"]).withColumn("model", F.lit("flat")))
    return metrics.ranked(both, "MAPE", ["segment"]).select("model", "segment", F.round("MAPE", 6).alias("MAPE"), "rank")


# splits and samples -------------------------------------------------------------------------

def _bucket(key: str, seed: int = 42) -> str:
    return f"((({key} * 7919 + {seed} * 104729) * 31 + {key} % 101) % 10000)"


@query(f"SELECT o_orderkey, CASE WHEN {_bucket('o_orderkey')} < 1500 THEN 'test' WHEN {_bucket('o_orderkey')} < 2000 THEN 'validation' ELSE 'train' END AS split FROM orders")
def hash_split(spark, sf_dir):
    return sampling.with_split(table(spark, sf_dir, "orders"), "o_orderkey", 0.15, 0.05).select("o_orderkey", "split")


@query(f"SELECT o_orderkey FROM orders ORDER BY {_bucket('o_orderkey', 7)}, o_orderkey LIMIT 100")
def seeded_sample(spark, sf_dir):
    return sampling.sample(table(spark, sf_dir, "orders"), "o_orderkey", 100, 7).select("o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def top_rows(spark, sf_dir):
    return sampling.head(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 15)


@query("SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INTEGER) AS fold FROM orders")
def contiguous_folds(spark, sf_dir):
    return sampling.folds(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7)


# contracts and set operations ---------------------------------------------------------------

@query(f"""WITH {TELEMETRY}, r AS (SELECT event_id, hora + event_id % 4 AS hora, CASE WHEN event_id % 50 <> 0 THEN -80.0::DOUBLE - (event_id % 13) END AS latitude FROM tel)
SELECT event_id, concat_ws(',', CASE WHEN hora IS NULL OR hora > 23 THEN 'hora' END, CASE WHEN latitude IS NULL OR latitude < -90 THEN 'latitude' END) AS reasons FROM r""")
def request_contract(spark, sf_dir):
    t = telemetry(spark, sf_dir).select("event_id", (F.col("hora") + F.col("event_id") % 4).alias("hora"), F.when(F.col("event_id") % 50 != 0, F.lit(-80.0) - F.col("event_id") % 13).alias("latitude"))
    checked = rows.check_columns(t, ["hora", "latitude"], ["consumo_kwh"])
    return rows.judged(checked).select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {TELEMETRY} SELECT event_id, data, hora, consumo_kwh, k FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN try_cast(json_extract_string(props, '$.k') AS DOUBLE) END AS k FROM tel) WHERE k IS NOT NULL")
def final_table(spark, sf_dir):
    t = telemetry(spark, sf_dir).withColumn("k", F.when(F.col("event_id") % 7 != 0, scalars.number(scalars.json_scalar("props", "k")))).withColumn("data", F.date_format("data", "yyyy-MM-dd"))
    return rows.for_model(t.drop("ts", "props", "machine_type"), enrich.IDENTIFIERS)


@query("SELECT CAST(o_orderkey AS INTEGER) AS k, CAST(round(o_totalprice) AS BIGINT) AS price, try_cast(o_orderpriority AS BIGINT) AS priority FROM orders")
def bulk_casts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.round("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    return rows.cast_all(o, {"k": "int", "price": "bigint", "priority": "bigint"})


@query("""SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'union all', count(*) FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'semi', count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def set_operations(spark, sf_dir):
    c, s, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "orders")
    a, b = c.select(F.col("c_nationkey").alias("k")), s.select(F.col("s_nationkey").alias("k"))
    parts = {"union": associations.union_distinct(a, b), "union all": associations.union_all(a, b), "except": c.select("c_custkey").subtract(o.select("o_custkey")), "semi": rows.members(c.select("c_custkey"), o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH {TELEMETRY}, j AS (SELECT *, hora IS NULL OR hora > 20 AS bad FROM (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN hora END AS hora FROM tel))
SELECT event_id, hora, CASE WHEN bad THEN 'rejected' ELSE 'valid' END AS part, CAST(count(*) FILTER (NOT bad) OVER () AS VARCHAR) AS n_valid FROM j""")
def checked_write(spark, sf_dir):
    """Rows parted into valid and rejected ones as they are written, and the count that the same pass gathered."""
    df = telemetry(spark, sf_dir).select("event_id", F.when(F.col("event_id") % 13 != 0, F.col("hora")).alias("hora"))
    path = f"{shared_folder(spark)}/checked-{uuid.uuid4().hex}"
    checks = checked.write(df, path, ["hora"], ranges=(("hora", 0, 20),))
    n = checks.filter("check = 'rows'").select(F.col("detail").alias("n_valid"))
    return spark.read.parquet(path).select("event_id", "hora", "part").crossJoin(F.broadcast(n))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice FROM orders")
def versioned_append(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    new = o.filter("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    path = f"{shared_folder(spark)}/versions-{uuid.uuid4().hex}"
    versions.append(o.filter("o_orderkey % 2 <> 0"), path, ["o_orderkey"])
    versions.append(new, path, ["o_orderkey"])
    return versions.read(spark, path)


@query("""SELECT 'columns' AS "check", true AS passed, '' AS detail UNION ALL SELECT 'rows', count(*) > 0, CAST(count(*) AS VARCHAR) FROM lineitem UNION ALL SELECT 'complete', true, '0' UNION ALL SELECT 'l_quantity positive', min(l_quantity) > 0, '' FROM lineitem""")
def sanity_checks(spark, sf_dir):
    return training.checklist(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_tax"], ["l_quantity"])


# models (no SQL) ----------------------------------------------------------------------------

def _examples(spark, sf_dir):
    h = F.col("hora").cast("double")
    t = telemetry(spark, sf_dir).withColumn("tipo_maquina", machines.machine_type("machine_type"))
    sine, cosine = scalars.cyclical("hora", 24)
    return t.select(F.col("event_id").alias("row_key"), "tipo_maquina", h.alias("hora"), sine.alias("hora_sin"), cosine.alias("hora_cos"), (F.col("unit_id") * 1.0).alias("unidade"), scalars.number(scalars.json_scalar("props", "k")).alias("k"), "consumo_kwh").na.fill(0.0)


_FEATURES = ["hora", "hora_sin", "hora_cos", "unidade", "k"]
_CONFIG = training.Config(features=_FEATURES, models=["linear", "tree", "forest", "gbt"], params={"forest": {"numTrees": 10, "maxDepth": 5}, "gbt": {"maxIter": 5, "maxDepth": 3}})


@query()
def model_comparison(spark, sf_dir):
    return training.compare(_examples(spark, sf_dir), _CONFIG)[0]


@query()
def segment_models(spark, sf_dir):
    return training.fit_segments(_examples(spark, sf_dir), training.Config(features=_FEATURES, models=["linear", "tree"]))[1]


@query()
def segment_scores(spark, sf_dir):
    """The best of four kinds of model for each type of machine, all of them applied in one look at the rows."""
    df = _examples(spark, sf_dir)
    return training.predict_segments(df, training.fit_segments(df, _CONFIG)[0], _CONFIG).select("row_key", "tipo_maquina", "prediction")


@query()
def whole_and_segment_scores(spark, sf_dir):
    config = training.Config(features=_FEATURES, models=["linear"])
    df = _examples(spark, sf_dir)
    name = "SPLITÃO"
    return training.predict_both(df, training.fit(df, config, "linear"), training.fit(df.filter(F.col("tipo_maquina") == name), config, "linear"), name, config).select("row_key", "global_prediction", "segment_prediction")


@query()
def tuned_model(spark, sf_dir):
    df = _examples(spark, sf_dir)
    model, params, error = training.tune(df, training.Config(features=_FEATURES, draws=3), "tree")
    return model.transform(df).select("row_key", "prediction")


# linear models of one feature, which SQL can fit too

_LINE_CONFIG = training.Config(features=["hora"], models=["linear"])
_EXAMPLES = f"""{TELEMETRY}, ex AS (SELECT event_id AS row_key, CASE trim(machine_type) WHEN 'splitao' THEN 'SPLITÃO' WHEN 'Split-Wall' THEN 'SPLIT HI-WALL' WHEN 'self' THEN 'SPLITÃO SELF CONTAINED' WHEN 'piso-teto' THEN 'SPLIT PISO-TETO' ELSE 'DESCONHECIDO' END AS tipo_maquina,
CAST(hora AS DOUBLE) AS hora, coalesce(consumo_kwh, 0.0) AS y, {_bucket("event_id")} < 1500 AS tested FROM tel),
line AS (SELECT tipo_maquina, regr_slope(y, hora) AS b, regr_intercept(y, hora) AS a, count(*) AS n_train FROM ex WHERE NOT tested GROUP BY 1), pr AS (SELECT ex.*, a + b * hora AS p, n_train FROM ex JOIN line USING (tipo_maquina))"""


@query(f"WITH {_EXAMPLES} SELECT row_key, tipo_maquina, round(p, 6) AS prediction FROM pr")
def line_scores_by_segment(spark, sf_dir):
    df = _examples(spark, sf_dir)
    scored = training.predict_segments(df, training.fit_segments(df, _LINE_CONFIG)[0], _LINE_CONFIG)
    return scored.select("row_key", "tipo_maquina", F.round("prediction", 6).alias("prediction"))


@query(f"WITH {_EXAMPLES} SELECT tipo_maquina AS segment, 'linear' AS model, any_value(n_train) AS n_train, {_METRICS.replace('count(*) AS n,', 'count(*) AS n_test,')} FROM pr WHERE tested GROUP BY 1")
def line_report_by_segment(spark, sf_dir):
    report = training.fit_segments(_examples(spark, sf_dir), _LINE_CONFIG)[1]
    return _rounded(report.filter("rank = 1")).select("segment", "model", F.col("n_train").cast("bigint").alias("n_train"), "n_test", *metrics.NAMES)


@query(f"""WITH {_EXAMPLES}, r AS (SELECT CAST(count(*) AS BIGINT) AS n, avg(abs(p - y)) AS "MAE", avg(abs(p - y) / greatest(abs(y), 1e-8) * 100) AS "MAPE" FROM pr WHERE tested GROUP BY tipo_maquina)
SELECT CAST(sum(n) AS BIGINT) AS n_test, round(sum("MAE" * n) / sum(n), 6) AS "MAE", round(sum("MAPE" * n) / sum(n), 6) AS "MAPE" FROM r""")
def line_report_of_all(spark, sf_dir):
    one = training.consolidated_report(training.fit_segments(_examples(spark, sf_dir), _LINE_CONFIG)[1])
    return one.select("n_test", F.round("MAE", 6).alias("MAE"), F.round("MAPE", 6).alias("MAPE"))


@query(f"""WITH {_EXAMPLES}, g AS (SELECT regr_slope(y, hora) AS gb, regr_intercept(y, hora) AS ga FROM ex), s AS (SELECT regr_slope(y, hora) AS sb, regr_intercept(y, hora) AS sa FROM ex WHERE tipo_maquina = 'SPLITÃO')
SELECT row_key, round(ga + gb * hora, 6) AS global_prediction, CASE WHEN tipo_maquina = 'SPLITÃO' THEN round(sa + sb * hora, 6) END AS segment_prediction FROM ex, g, s""")
def line_scores_of_both(spark, sf_dir):
    df, name = _examples(spark, sf_dir), "SPLITÃO"
    own = training.fit(df.filter(F.col("tipo_maquina") == name), _LINE_CONFIG, "linear")
    both = training.predict_both(df, training.fit(df, _LINE_CONFIG, "linear"), own, name, _LINE_CONFIG)
    return both.select("row_key", *[F.round(c, 6).alias(c) for c in ("global_prediction", "segment_prediction")])


# from raw rows: outlier filter, feature chain and model, fitted and kept as one pipeline

# limits of the plain settings, as no type of machine here is one of the steadier or more varied kinds
_RAW = f"""{_READY}, ork AS (SELECT CASE WHEN trim(machine_type) = '' THEN 'DESCONHECIDO' ELSE machine_type END AS seg, consumo_kwh AS v, row_number() OVER (PARTITION BY trim(machine_type) ORDER BY consumo_kwh) AS rk,
  count(*) OVER (PARTITION BY trim(machine_type)) AS n FROM obs WHERE {_TRAINED} AND consumo_kwh IS NOT NULL),
oq AS (SELECT seg, max(n) AS n, {_rank('0.10')} AS q10, {_rank('0.25')} AS q1, {_rank('0.50')} AS q50, {_rank('0.75')} AS q3, {_rank('0.90')} AS q90, {_rank('0.99')} AS q99 FROM ork GROUP BY seg),
ot AS (SELECT *, greatest(q90 - q50, 1e-9) AS mid, greatest(q50 - q10, 1e-9) AS low, greatest(q99 - q90, 0) / greatest(q90 - q50, 1e-9) AS tail FROM oq),
os AS (SELECT *, CASE WHEN greatest(q90 - q10, 1e-9) <= 0.35 * greatest(q50, 1e-6) AND mid / low < 1.8 THEN 0.07 ELSE 0.05 END AS qn,
  CASE WHEN tail >= 1.5 THEN 1.25 WHEN tail >= 1.0 THEN 1.40 WHEN tail >= 0.6 THEN 1.60 ELSE 3.0 END AS k, CASE WHEN tail >= 1.5 THEN 0.985 WHEN tail >= 1.0 THEN 0.99 WHEN tail >= 0.6 THEN 0.995 END AS qc FROM ot),
oa AS (SELECT seg, min(CASE WHEN rk > floor(qn * (ork.n - 1) + 0.5) THEN v END) AS vn, min(CASE WHEN rk > floor(qc * (ork.n - 1) + 0.5) THEN v END) AS vc FROM ork JOIN os USING (seg) GROUP BY seg),
ol AS (SELECT seg, greatest(q1 - k * (q3 - q1), least(greatest(vn, 0.5), 2.0)) AS lo, least(q3 + k * (q3 - q1), coalesce(vc, q3 + k * (q3 - q1))) AS hi FROM os JOIN oa USING (seg)),
kt AS (SELECT tr.* FROM tr JOIN ol ON seg = CASE WHEN trim(machine_type) = '' THEN 'DESCONHECIDO' ELSE machine_type END WHERE consumo_kwh BETWEEN lo AND greatest(hi, lo)),
gm AS (SELECT avg(consumo_kwh) AS g FROM kt), te AS (SELECT hora, (count(*) * avg(consumo_kwh) + 10 * any_value(g)) / (count(*) + 10) AS enc FROM kt, gm GROUP BY 1),
mx AS (SELECT event_id, consumo_kwh AS y, enc::FLOAT::DOUBLE AS x, {_bucket("event_id")} < 1500 AS tested FROM kt JOIN te USING (hora)),
ln AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n_train FROM mx WHERE NOT tested)"""
_RAW_SETTINGS = raw.Settings(training.Config(features=None, key="event_id", models=["linear"]), inputs=("hora_target_enc",))


@query(f"WITH {_RAW} SELECT event_id, round(a + b * coalesce(enc, g)::FLOAT::DOUBLE, 4) AS prediction FROM obs LEFT JOIN te USING (hora), gm, ln WHERE NOT ({_TRAINED})")
def raw_rows_scored(spark, sf_dir):
    """Fitted on raw rows, written to the shared folder, read again, and applied to raw rows that have no target."""
    df = views.observations(spark, sf_dir)
    model, _ = raw.fit(df.filter("event_id % 4 <> 0"), _RAW_SETTINGS, "linear")
    path = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    model.write().save(path)
    return raw.scored(df.filter("event_id % 4 = 0").drop("consumo_kwh", "estacao"), PipelineModel.load(path)).withColumn("prediction", F.round("prediction", 4))


@query(f"WITH {_RAW}, pr AS (SELECT y, a + b * x AS p, n_train FROM mx, ln WHERE tested) SELECT 'linear' AS model, any_value(n_train) AS n_train, {_METRICS.replace('count(*) AS n,', 'count(*) AS n_test,').replace(', 6)', ', 4)').replace(', 9)', ', 4)')} FROM pr")
def raw_rows_report(spark, sf_dir):
    """How the model fitted on raw rows does on its test rows."""
    report = raw.fit(views.observations(spark, sf_dir).filter("event_id % 4 <> 0"), _RAW_SETTINGS, "linear")[1]
    return report.select("model", F.col("n_train").cast("bigint").alias("n_train"), "n_test", *[F.round(c, 4).alias(c) for c in metrics.NAMES])


# many segments and many columns in one look

_PLANES = f"""ex AS (SELECT CAST(l_suppkey AS VARCHAR) AS segment, l_quantity::DOUBLE AS x1, l_discount::DOUBLE * 100 AS x2, l_extendedprice::DOUBLE / 1000 AS y, {_bucket('(l_orderkey * 8 + l_linenumber)')} < 1500 AS tested FROM lineitem),
m AS (SELECT segment, count(*) AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y FROM ex WHERE NOT tested GROUP BY 1),
pl AS (SELECT segment, n, m1, m2, my, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM m)"""
_PLANE_CONFIG = training.Config(features=["x1", "x2"], target="y", key="k", segment="segment", least_rows=1)


def _planes(spark, sf_dir):
    of = lambda c: F.col(c).cast("double")
    df = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"), F.col("l_suppkey").cast("string").alias("segment"), of("l_quantity").alias("x1"), (of("l_discount") * 100).alias("x2"), (of("l_extendedprice") / 1000).alias("y"))
    return training.line_models(df, _PLANE_CONFIG)


@query(f"WITH {_PLANES} SELECT segment, n AS n_train, round(b1, 5) AS b1, round(b2, 5) AS b2, round(my - b1 * m1 - b2 * m2, 5) AS intercept FROM pl")
def plane_of_each_segment(spark, sf_dir):
    """Linear models of two features for every supplier, in one look at the rows."""
    by = F.col("coefficients")
    return _planes(spark, sf_dir)[0].select("segment", F.col("n").alias("n_train"), F.round(by[0], 5).alias("b1"), F.round(by[1], 5).alias("b2"), F.round("intercept", 5).alias("intercept"))


@query(f"""WITH {_PLANES} SELECT segment, any_value(n) AS n_train, count(*) AS n_test, round(avg(abs(p - y)), 5) AS "MAE", round(avg(abs(p - y) / greatest(abs(y), 1e-8) * 100), 4) AS "MAPE"
FROM (SELECT ex.*, n, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM ex JOIN pl USING (segment)) WHERE tested GROUP BY 1""")
def plane_report_by_segment(spark, sf_dir):
    report = _planes(spark, sf_dir)[1].filter("n_test is not null and n_train is not null")
    return report.select("segment", "n_train", "n_test", F.round("MAE", 5).alias("MAE"), F.round("MAPE", 4).alias("MAPE"))


_WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey", "l_partkey", "l_orderkey"]


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr({a}::DOUBLE, {b}::DOUBLE), 9) AS r FROM lineitem WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for i, a in enumerate(_WIDE) for b in _WIDE[i + 1 :]) + ")")
def wide_correlations(spark, sf_dir):
    return gram.correlations(table(spark, sf_dir, "lineitem"), _WIDE).withColumn("r", F.round("r", 9))


_PROFILED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax", "l_quantity"]


@query("SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '{c}' AS column, count(*) AS n, count(*) FILTER ({c} IS NULL) AS n_null, {f"min({c})::DOUBLE" if i > 1 else "NULL::DOUBLE"} AS low, {f"max({c})::DOUBLE" if i > 1 else "NULL::DOUBLE"} AS high,
count(DISTINCT {c}) AS n_distinct, (SELECT max(k) FROM (SELECT count(*) AS k FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c})) AS n_most FROM lineitem""" for i, c in enumerate(_PROFILED)) + ")")
def merged_profile(spark, sf_dir):
    """Profiles of three parts of a table, each written where a later one finds it, merged without a look at the rows; values are few enough for exact sketches."""
    df, path = table(spark, sf_dir, "lineitem"), f"{shared_folder(spark)}/profiles-{uuid.uuid4().hex}"
    for i in range(3):
        sketches.profile(df.filter(F.col("l_orderkey") % 3 == i), _PROFILED).write.parquet(f"{path}/part={i}")
    found = sketches.merged(spark.read.parquet(path).drop("part"))
    most = sketches.frequent(found, 1).select("column", F.col("n").alias("n_most"))
    return sketches.summary(found).join(most, "column", "left").select("column", "n", "n_null", "low", "high", "n_distinct", "n_most")
