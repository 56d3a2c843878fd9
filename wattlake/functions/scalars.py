"""Scalar expressions.  All are built-in functions, so plans stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def family(device: Column | str) -> Column:
    """The device family: the first eight characters of its code."""
    return F.substring(col(device), 1, 8)


def label_or(c: Column | str, unknown: str) -> Column:
    """*unknown* for null and blank labels, else the label."""
    return F.when(F.coalesce(F.trim(col(c)), F.lit("")) == "", F.lit(unknown)).otherwise(col(c))


def replaced(c: Column | str, mapping: dict[str, str]) -> Column:
    """Values in *mapping* (small, fixed) are replaced, others kept."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col(c)), col(c))


def safe_name(c: Column | str) -> Column:
    """Usable in file names: slashes and spaces become underscores."""
    return F.regexp_replace(col(c), "[/ ]", "_")


def override_key(c: Column | str) -> Column:
    """One key for the spellings of a segment in override tables: upper case, hyphens and underscores as spaces."""
    return F.regexp_replace(F.upper(col(c)), "[-_]", " ")


def piece(c: Column | str, separator: str, i: int) -> Column:
    """The i-th part of a split by a literal; null if there is none."""
    return F.get(F.split(col(c), "\\Q" + separator + "\\E"), F.lit(i))


def number(c: Column | str) -> Column:
    """The text as a double, null if it is none."""
    return col(c).try_cast("double")


def date_of(c: Column | str, pattern: str = "M/d/yy") -> Column:
    """Text to date, null if it doesn't fit; the default takes padded and unpadded days."""
    return F.try_to_date(col(c), pattern)


def iso_date(c: Column | str) -> Column:
    """ISO date or date-time text to date."""
    return F.try_to_date(F.substring(col(c), 1, 10), "yyyy-MM-dd")


def hour_stamp(day: Column | str, hour: Column | str) -> Column:
    """Date and hour as a timestamp without zone, so that no clock change shifts it."""
    return F.timestamp_add("HOUR", col(hour).cast("int"), col(day).cast("timestamp_ntz"))


def json_scalar(c: Column | str, key: str) -> Column:
    """The scalar at ``$.key``; null for arrays and objects."""
    found = F.get_json_object(col(c), f"$.{key}")
    return F.when(~found.rlike(r"^\s*[\[{]"), found)


def int_range(low: Column, high: Column) -> Column:
    """low..high as an array; empty if low is over high."""
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def overlap(start: Column, end: Column, low: Column, high: Column) -> Column:
    """How much of [start, end) lies in [low, high)."""
    return F.greatest(F.least(end, high) - F.greatest(start, low), F.lit(0.0))


def clip(c: Column | str, low: Column | float, high: Column | float) -> Column:
    """Limited to [low, high]; null stays null."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.when(col(c).isNotNull(), F.least(F.greatest(col(c), low), high))


def min_max(c: Column | str, low: Column | float, high: Column | float) -> Column:
    """Clipped and scaled to 0..1; 0 where the range is empty, null where the value is."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    scaled = F.coalesce(F.try_divide(clip(c, low, high) - low, high - low), F.lit(0.0))
    return F.when(col(c).isNotNull(), scaled)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points in degrees."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def cyclical(c: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of the value's place in its period."""
    turn = col(c) * F.lit(2.0 * 3.141592653589793 / period)
    return F.sin(turn), F.cos(turn)


def sane(c: Column | str) -> Column:
    """0.0 for NaN and infinite values; null stays null."""
    return F.when(F.isnan(col(c)) | (F.abs(col(c)) == float("inf")), F.lit(0.0)).otherwise(col(c))


def relative_error(actual: Column, predicted: Column, least: float = 1e-8) -> Column:
    """Percent of the actual value, whose size counts as *least* at least."""
    return F.abs(predicted - actual) / F.greatest(F.abs(actual), F.lit(least)) * 100.0
