"""Seasons, day periods and the calendar of holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.scalars import col

# Labels of the data.
SUMMER, AUTUMN, WINTER, SPRING, NO_SEASON = "verao", "outono", "inverno", "primavera", "desconhecida"
PERIODS = ("Madrugada", "Manhã", "Tarde", "Noite")
#: National holidays, (month, day, first year).
HOLIDAYS = ((1, 1, 0), (4, 21, 0), (5, 1, 0), (9, 7, 0), (10, 12, 0), (11, 2, 0), (11, 15, 0), (11, 20, 2024), (12, 25, 0))


def season_of_day(day: Column | str) -> Column:
    """By day: summer from 21 December, autumn from 21 March, winter from 21 June, spring from 23 September and for null."""
    at = F.month(col(day)) * 100 + F.dayofmonth(col(day))
    return F.when((at >= 1221) | (at <= 320), SUMMER).when(at.between(321, 620), AUTUMN).when(at.between(621, 922), WINTER).otherwise(SPRING)


def season_of_month(month: Column | str) -> Column:
    """By month alone: three months each from December on; others and null are unknown."""
    m = col(month)
    return F.when(m.isin(12, 1, 2), SUMMER).when(m.between(3, 5), AUTUMN).when(m.between(6, 8), WINTER).when(m.between(9, 11), SPRING).otherwise(NO_SEASON)


def period_id(hour: Column | str) -> Column:
    """0 to hour 6, 1 to 11, 2 to 18, else (and for null) 3."""
    h = col(hour)
    return F.when(h.between(0, 6), 0).when(h.between(7, 11), 1).when(h.between(12, 18), 2).otherwise(3)


def period(hour: Column | str) -> Column:
    return F.get(F.array(*map(F.lit, PERIODS)), period_id(hour))


def good_friday(year: Column) -> Column:
    """Two days before Easter, by the Gregorian computus, for any year."""
    by = lambda a, b: F.floor(a / b)
    golden, century = year % 19, by(year, 100)
    moon = (century - by(century, 4) - by(8 * century + 13, 25) + 19 * golden + 15) % 30
    moon = moon - by(moon, 28) * (1 - by(moon, 28) * by(F.lit(29), moon + 1) * by(21 - golden, 11))
    weekday = (year + by(year, 4) + moon + 2 - century + by(century, 4)) % 7
    return F.date_add(F.make_date(year, F.lit(3), F.lit(26)), (moon - weekday).cast("int"))  # Easter is so many days after 28 March


def is_holiday(day: Column) -> Column:
    """Whether a date is a national holiday; null for null."""
    at = F.month(day) * 100 + F.dayofmonth(day)
    fixed = [(at == m * 100 + d) & (F.year(day) >= since) for m, d, since in HOLIDAYS]
    found = day == good_friday(F.year(day))
    for f in fixed:
        found = found | f
    return found


def with_calendar(df: DataFrame, day: str) -> DataFrame:
    """Adds mes, trimestre, dia_semana (Monday 1), feriado, vespera_feriado (the day after is a holiday) and dia_util."""
    at = F.col(day).cast("date")
    flag, eve = (F.when(is_holiday(d), 1).otherwise(0) for d in (at, F.date_add(at, 1)))
    week = F.weekday(day) + 1
    return df.withColumns({
        "mes": F.month(day), "trimestre": F.quarter(day), "dia_semana": week, "feriado": flag, "vespera_feriado": eve,
        "dia_util": F.when((week <= 5) & (flag == 0), 1).otherwise(0),
    })
