"""From enriched rows to model inputs: fitted once, kept as small tables, applied to any rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions import dates
from wattlake.functions.machines import machine_type
from wattlake.operators import encoders, geo, rows
from wattlake.session import forget, stash
from wattlake.sources.weather import MEASURES

TARGET = "consumo_kwh"
LAGS = ["consumo_lag_1h", "consumo_lag_24h", "consumo_rolling_mean_3h"]
MEASURED = [*MEASURES.values(), *LAGS]
CALENDAR = ["trimestre", "is_feriado", "is_vespera_feriado", "is_dia_util"]
#: Index columns of the inputs that are looked up rather than computed with.
INDEXED = ["hora", "mes", "grupo_regional", "periodo_dia"]


@dataclass(frozen=True)
class Settings:
    """Which columns a row must have, and what becomes of them."""

    fields: tuple[str, ...] = ("hora", "data", TARGET, "machine_type", "estacao", "grupo_regional", *MEASURED)
    encoded: tuple[str, ...] = ("hora", "mes")
    indexed: tuple[str, ...] = ("grupo_regional",)
    hot: tuple[str, ...] = ("tipo_maquina", "estacao", "periodo_dia")
    clipped: tuple[str, ...] = tuple(MEASURED)
    target: str = TARGET
    smoothing: float = 10.0


@dataclass
class Fitted:
    """What was learned from training rows: a few rows for each column, and the order of the columns."""

    encodings: DataFrame  # column, value, encoding, global_mean
    indices: DataFrame  # column, value, idx
    limits: DataFrame  # column, q1, q3, iqr, lower, upper
    vocabularies: dict[str, list[str]]
    columns: list[str]
    settings: Settings = field(default_factory=Settings)


def with_dates(df: DataFrame, day: str = "data", hour: str = "hora") -> DataFrame:
    """Adds mes, trimestre, is_feriado, is_vespera_feriado, is_dia_util and periodo_dia; the day itself, ``dia`` and ``ano`` go."""
    out = dates.with_calendar(df.withColumn(day, F.col(day).cast("date")), day)
    out = out.withColumnsRenamed({"feriado": "is_feriado", "vespera_feriado": "is_vespera_feriado", "dia_util": "is_dia_util"})
    return out.withColumn("periodo_dia", dates.period(hour)).drop(day, "dia", "ano", "dia_semana")


def typed(df: DataFrame) -> DataFrame:
    """The machine's type under its one name, as tipo_maquina; the spelling goes."""
    return df.withColumn("tipo_maquina", machine_type("machine_type")).drop("machine_type")


def prepared(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Complete rows with calendar features and machine types; a missing field is an error."""
    return typed(with_dates(rows.complete(rows.check_columns(df, list(settings.fields)), list(settings.fields))))


def built(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The plain feature table: prepared rows with dummies of the categories that occur in them."""
    ready = prepared(df, settings)
    return encoders.one_hot(ready, {c: encoders.vocabulary(ready, c) for c in settings.hot})


def fit(df: DataFrame, settings: Settings = Settings()) -> Fitted:
    """Encodings, indices, limits and vocabularies of training rows, and the columns of their feature table.

    The prepared rows are written once, without what no fit needs; all categories are counted in one look.
    """
    s = settings
    every = prepared(df, settings)
    ready = stash(every.select(*dict.fromkeys([s.target, *s.encoded, *s.indexed, *s.hot, *[c for c in s.clipped if c in every.columns]])))
    names = dict.fromkeys([*s.encoded, *s.indexed, *s.hot])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in names]
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.lit("all").alias("value"))  # the mean of all rows, beside those of categories
    counted = stash(ready.select(F.col(s.target).alias("_y"), F.explode(F.array(whole, *entries)).alias("_c")).filter("_c.value is not null").groupBy("_c.column", "_c.value").agg(F.avg("_y").alias("m"), F.count("_y").alias("k")))
    total = counted.filter("column is null").select(F.col("m").alias("global_mean"))
    shrunk = (F.col("k") * F.col("m") + s.smoothing * F.col("global_mean")) / (F.col("k") + s.smoothing)
    encodings = stash(counted.filter(F.col("column").isin(*s.encoded)).crossJoin(F.broadcast(total)).select("column", "value", shrunk.alias("encoding"), "global_mean"))
    indices = [encoders.fit_index(ready, c).select(F.lit(c).alias("column"), F.col("value").cast("string").alias("value"), "idx") for c in s.indexed]
    vocabularies = {c: encoders.vocabulary(counted.filter(F.col("column") == c), "value") for c in s.hot}
    gone = {s.target, *s.encoded, *s.hot}
    plain = [c for c in s.fields if c in every.columns and c not in gone]
    columns = [*plain, *CALENDAR, *[f"{c}_{v}" for c in s.hot for v in vocabularies[c]], *[f"{c}_target_enc" for c in s.encoded]]
    limits = stash(encoders.fit_clip(ready, list(s.clipped)))
    indices = stash(_all(indices, df, "column string, value string, idx int"))
    forget(ready, counted)
    return Fitted(encodings, indices, limits, vocabularies, columns, s)


def _all(parts: list[DataFrame], df: DataFrame, schema: str) -> DataFrame:
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], schema)


def save(fitted: Fitted, path: str) -> None:
    """Writes the fitted tables as Parquet under *path*."""
    spark = fitted.limits.sparkSession
    s = fitted.settings
    words = [(c, v) for c, values in fitted.vocabularies.items() for v in values]
    named = [(kind, i, c) for kind in ("fields", "encoded", "indexed", "hot", "clipped") for i, c in enumerate(getattr(s, kind))]
    named += [("columns", i, c) for i, c in enumerate(fitted.columns)] + [("target", 0, s.target)]
    tables = {
        "encodings": fitted.encodings, "indices": fitted.indices, "limits": fitted.limits, "vocabularies": spark.createDataFrame(words, "column string, value string"),
        "names": spark.createDataFrame(named, "kind string, place int, name string"), "numbers": spark.createDataFrame([("smoothing", float(s.smoothing))], "name string, value double"),
    }
    for name, table in tables.items():
        rows.small_table(table).write.mode("overwrite").parquet(f"{path}/{name}")


def load(spark: SparkSession, path: str) -> Fitted:
    """What :func:`save` has written."""
    t = {n: spark.read.parquet(f"{path}/{n}") for n in ("encodings", "indices", "limits", "vocabularies", "names", "numbers")}
    names: dict[str, list[str]] = {}
    for r in t["names"].orderBy("kind", "place").collect():
        names.setdefault(r["kind"], []).append(r["name"])
    settings = Settings(*[tuple(names.get(k, ())) for k in ("fields", "encoded", "indexed", "hot", "clipped")], names["target"][0], t["numbers"].first()["value"])
    vocabularies: dict[str, list[str]] = {c: [] for c in settings.hot}
    for r in t["vocabularies"].orderBy("column", "value").collect():
        vocabularies[r["column"]].append(r["value"])
    return Fitted(t["encodings"], t["indices"], t["limits"], vocabularies, names["columns"], settings)


def _encoded(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Target encodings instead of their columns; the global mean for values that weren't seen and null."""
    for c in fitted.settings.encoded:
        own = fitted.encodings.filter(F.col("column") == c).drop("column")
        df = encoders.apply_target(df.withColumn(c, F.col(c).cast("string")), own, c)
    return df


def _indexed(df: DataFrame, fitted: Fitted) -> DataFrame:
    """Indices instead of categories; -1 for values that weren't seen and null."""
    for c in fitted.settings.indexed:
        own = fitted.indices.filter(F.col("column") == c).drop("column")
        df = encoders.apply_index(df.withColumn(c, F.col(c).cast("string")), own, c).drop(c).withColumnRenamed(f"{c}_idx", c)
    return df


def _scaled(df: DataFrame, fitted: Fitted, hot: list[str]) -> DataFrame:
    """Dummies of the fitted vocabularies, clipped and scaled measures, no NaN or infinite values."""
    return encoders.sanitised(encoders.apply_clip(encoders.one_hot(df, {c: fitted.vocabularies[c] for c in hot}), fitted.limits))


def apply(ready: DataFrame, fitted: Fitted, keys: list[str] | None = None) -> DataFrame:
    """The feature table of :func:`prepared` (or :func:`derived` and typed) rows: *keys*, then the fitted columns as floats, 0 where absent."""
    return rows.aligned(_scaled(_indexed(_encoded(ready, fitted), fitted), fitted, list(fitted.settings.hot)), fitted.columns, keys)


def derived(df: DataFrame, reference: DataFrame | None = None, target: str = TARGET) -> DataFrame:
    """Rows to score with what training rows have: target (0), calendar features, season by month, and regional group.

    The group is that of the nearest coordinate of *reference* if the rows have none; rows with
    neither a group nor coordinates, or without a reference where one is needed, are an error.
    """
    if "grupo_regional" not in df.columns and not {"latitude", "longitude"} <= set(df.columns):
        raise ValueError("latitude and longitude, or grupo_regional, must be there")
    if "grupo_regional" not in df.columns and reference is None:
        raise ValueError("a reference of groups is needed")
    out = with_dates(rows.with_target(rows.named(df, {"tipo_maquina": "machine_type"}), target))
    out = out.withColumn("estacao", dates.season_of_month("mes"))
    return out if "grupo_regional" in df.columns else geo.assign(out, reference.select("latitude", "longitude", "grupo_regional"))


def scored(df: DataFrame, fitted: Fitted, reference: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """The feature table of rows to score: what is missing is derived, what was fitted is applied."""
    return apply(typed(derived(df, reference, fitted.settings.target)), fitted, keys)


def dense_inputs(df: DataFrame, fitted: Fitted, sizes: dict[str, int], reference: DataFrame | None = None, keys: list[str] | None = None) -> DataFrame:
    """*keys*, the four index columns as integers, ``dense`` (floats of the other fitted columns) and ``valid``.

    A row is valid if each of its indices is there, not negative and below its size; nothing is
    to be predicted for others.
    """
    ready = typed(derived(df, reference, fitted.settings.target))
    ready = ready.withColumns({"hora": F.col("hora").cast("int"), "mes": F.col("mes").cast("int"), "grupo_regional": F.col("grupo_regional").cast("int"), "periodo_dia": dates.period_id("hora").cast("int")})
    names = [c for c in fitted.columns if c not in INDEXED and not c.startswith("periodo_dia_") and not c.endswith("_target_enc")]
    scaled = _scaled(ready, fitted, [c for c in fitted.settings.hot if c not in INDEXED])
    have = set(scaled.columns)
    dense = F.array(*[F.col(f"`{c}`").cast("float") if c in have else F.lit(0.0).cast("float") for c in names])
    return scaled.select(*(keys or []), *INDEXED, dense.alias("dense"), encoders.within(sizes).alias("valid"))
