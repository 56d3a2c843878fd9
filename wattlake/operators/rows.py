"""Projections, filters and contracts on rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.scalars import iso_date, label_or

#: Ranges that a scoring request must keep: column, least, greatest (None: no bound).
RANGES = (("hora", 0, 23), ("latitude", -90, 90), ("longitude", -180, 180), ("Umidade_Relativa_%", 0, 100), ("Precipitacao_mm", 0, None), ("Velocidade_Vento_kmh", 0, None), ("Irradiancia_Direta_Wm2", 0, None), ("Irradiancia_Difusa_Wm2", 0, None))


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The columns of *types*, cast and in that order; values that can't be cast become null."""
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in types.items()])


def complete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null in *columns* (all by default).  NaN is a value and stays."""
    return df.filter(reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns or df.columns], F.lit(True)))


def positive(df: DataFrame, value: str = "consumo_kwh") -> DataFrame:
    return df.filter(F.col(value) > 0)


def in_validity(df: DataFrame, day: str = "data", first: str = "data_instalacao", last: str = "data_inicio_automacao", value: str = "consumo_kwh") -> DataFrame:
    """Rows with a positive value on a day from *first* to *last*, both included."""
    return df.filter(F.col(day).between(F.col(first), F.col(last)) & (F.col(value) > 0))


def members(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in *ids*, whatever its size: the planner picks the join."""
    return df.join(ids.select(on), on, "left_semi")


def dated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns of ISO dates as dates."""
    return df.withColumns({c: iso_date(c) for c in columns})


def date_like(df: DataFrame) -> list[str]:
    """Text columns of ISO dates: all their values are dates, in one look at the rows.

    A column of which half or more are dates and others are not is an error that names it and
    counts them, as neither reading would keep its rows; codes and other text stay text.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return []
    good = {c: F.col(f"`{c}`").rlike(r"^\d{4}-\d{2}-\d{2}$") & iso_date(f"`{c}`").isNotNull() for c in texts}
    seen = df.agg(*[F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(texts)], *[F.count_if(g).alias(f"d{i}") for i, g in enumerate(good.values())]).first()
    counts = {c: (seen[f"d{i}"], seen[f"n{i}"]) for i, c in enumerate(texts)}
    mixed = [f"{c}: {n - d} of {n} values are no dates" for c, (d, n) in counts.items() if n > d >= n / 2 > 0]
    if mixed:
        raise ValueError("; ".join(mixed))
    return [c for c, (d, n) in counts.items() if d == n > 0]


def for_model(df: DataFrame, drop: list[str]) -> DataFrame:
    """Text of dates as dates, without the columns *drop* (where they exist), without incomplete rows."""
    kept = df.drop(*drop)
    return complete(dated(kept, date_like(kept)))


def one_of_each(df: DataFrame, key: list[str]) -> DataFrame:
    """One row of each key (null is one): that with the fewest nulls, of such the least, so that reruns agree."""
    rest = [c for c in df.columns if c not in key]
    nulls = sum((F.col(f"`{c}`").isNull().cast("int") for c in rest), F.lit(0))
    least = df.groupBy(*key).agg(F.min(F.struct(nulls.alias("_nulls"), *[f"`{c}`" for c in rest])).alias("_row"))
    return least.select(*key, "_row.*").select(df.columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def aligned(df: DataFrame, expected: list[str], keys: list[str] | None = None) -> DataFrame:
    """The columns *expected* as floats in that order, 0 where absent; others but *keys* are dropped."""
    have = set(df.columns)
    return df.select(*(keys or []), *[(F.col(f"`{c}`").cast("float") if c in have else F.lit(0.0).cast("float")).alias(c) for c in expected])


def with_target(df: DataFrame, target: str) -> DataFrame:
    """Adds a target of 0 if there is none."""
    return df if target in df.columns else df.withColumn(target, F.lit(0.0))


def named(df: DataFrame, variants: dict[str, str]) -> DataFrame:
    """Renames variants of a column's name where the wanted name isn't there."""
    return df.withColumnsRenamed({old: new for old, new in variants.items() if old in df.columns and new not in df.columns})


def check_columns(df: DataFrame, required: list[str], forbidden: list[str] | None = None) -> DataFrame:
    """*df* itself; an error if a column lacks or a forbidden one (the target) is there.  Nothing is computed."""
    lacking, extra = [c for c in required if c not in df.columns], [c for c in forbidden or [] if c in df.columns]
    if lacking or extra:
        raise ValueError(f"missing columns {lacking}, unexpected columns {extra}")
    return df


def judged(df: DataFrame, ranges: tuple = RANGES) -> DataFrame:
    """Adds ``reasons``: the names of the columns that are null or out of range (empty: the row is valid)."""
    faults = []
    for name, low, high in ranges:
        if name in df.columns:
            c = F.col(f"`{name}`")
            bad = c.isNull()
            bad = bad | (c < low) if low is not None else bad
            bad = bad | (c > high) if high is not None else bad
            faults.append(F.when(bad, F.lit(name)))
    return df.withColumn("reasons", F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>"))


def segmented(df: DataFrame, c: str, unknown: str = "DESCONHECIDO") -> DataFrame:
    return df.withColumn(c, label_or(c, unknown))


def small_table(df: DataFrame) -> DataFrame:
    """A table of a few rows a column or segment, in one file when written."""
    return df.coalesce(1)
