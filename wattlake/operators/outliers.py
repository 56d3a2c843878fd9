"""Outlier filter that adapts its limits to each segment."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.scalars import override_key
from wattlake.operators.quantiles import grid, nearest
from wattlake.operators.rows import segmented
from wattlake.session import stash

FIXED = {"q10": 0.10, "q1": 0.25, "q50": 0.50, "q3": 0.75, "q90": 0.90, "q99": 0.99}
# Kinds of machine that are steadier or vary more, and what they change: factor of the fence, noise quantile, its bound.
STEADY, STEADY_FACTOR, STEADY_NOISE, STEADY_MOST = ("HI-WALL", "JANELA", "(ACJ)"), 0.90, 0.02, 0.20
VARIED, VARIED_NOISE, VARIED_LEAST = ("INVERTER", "ROOFTOP"), 0.01, 0.01
# From this ratio of tail to middle on, the most that the fence's factor is, the cap where none is set, and the most that the cap is (None: no bound).
TAILS = ((1.50, 1.25, 0.99, 0.985), (1.00, 1.40, 0.995, 0.99), (0.60, 1.60, 0.995, None))
# A segment is compact if its spread is within this share of the median and its halves are in this proportion; what that adds to the noise quantile, and its bound.
COMPACT_SHARE, COMPACT_HALVES, COMPACT_NOISE, COMPACT_MOST = 0.35, 1.8, 0.02, 0.20
# Bounds of the noise quantile and of the cap, the least size of a segment whose limits bend, the least factor that an override sets.
NOISE_BOUNDS, CAP_BOUNDS, LEAST_SIZE, LEAST_FACTOR = (0.0, 0.25), (0.90, 0.9999), 10, 0.1


@dataclass(frozen=True)
class Settings:
    """The floor of noise, the factor of the fence, the least rows of a segment that has limits of its own, the noise quantile, and a cap (None: no cap)."""

    noise_floor: float = 0.5
    iqr_factor: float = 3.0
    min_segment_size: int = 40
    noise_quantile: float = 0.05
    upper_quantile_cap: float | None = None


def _overridden(df: DataFrame, segment: str, overrides: DataFrame | None) -> DataFrame:
    """Adds the override columns (null where there is none)."""
    names = ["noise_floor", "iqr_factor", "min_segment_size", "noise_quantile", "upper_quantile_cap"]
    if overrides is None:
        return df.select("*", *[F.lit(None).cast("double").alias(f"o_{n}") for n in names], F.lit(False).alias("o_no_cap"), F.lit(False).alias("manual_override"))
    given = [(F.col(n).cast("double") if n in overrides.columns else F.lit(None).cast("double")).alias(f"o_{n}") for n in names]
    no_cap = F.coalesce(F.col("no_upper_cap").cast("boolean"), F.lit(False)) if "no_upper_cap" in overrides.columns else F.lit(False)
    # one row a key: of several the least
    small = overrides.select(override_key("segment").alias("_k"), F.struct(*given, no_cap.alias("o_no_cap")).alias("_o")).groupBy("_k").agg(F.min("_o").alias("_o"))
    joined = df.withColumn("_k", override_key(segment)).join(small, "_k", "left")
    return joined.withColumn("manual_override", F.col("_o").isNotNull()).select("*", "_o.*").withColumn("o_no_cap", F.coalesce("o_no_cap", F.lit(False))).drop("_k", "_o")


def _clamp(c: Column, bounds: tuple[float, float]) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(bounds[0])), F.lit(bounds[1])))


def _bent(name: Column, noise: Column, factor: Column, cap: Column) -> tuple[Column, Column, Column]:
    """Noise quantile, factor and cap as the segment's kind and shape bend them; from the columns q10 to q99 and tail_ratio."""
    of = lambda kinds: reduce(Column.__or__, [F.upper(name).contains(k) for k in kinds])
    noise = F.when(of(STEADY), F.least(noise + STEADY_NOISE, F.lit(STEADY_MOST))).otherwise(noise)
    noise = F.when(of(VARIED), F.greatest(noise - VARIED_NOISE, F.lit(VARIED_LEAST))).otherwise(noise)
    factor = F.when(of(STEADY), factor * STEADY_FACTOR).otherwise(factor)
    narrow, capped = factor, cap
    for ratio, most, default, bound in reversed(TAILS):
        heavy = F.col("tail_ratio") >= ratio
        narrow = F.when(heavy, F.least(factor, F.lit(most))).otherwise(narrow)
        limited = F.coalesce(cap, F.lit(default))
        capped = F.when(heavy, limited if bound is None else F.least(limited, F.lit(bound))).otherwise(capped)
    spread = F.greatest(F.col("q90") - F.col("q10"), F.lit(1e-9))
    compact = (spread <= F.greatest(F.col("q50"), F.lit(1e-6)) * COMPACT_SHARE) & (F.col("_mid") / F.col("_low") < COMPACT_HALVES)
    return F.when(compact, F.least(noise + COMPACT_NOISE, F.lit(COMPACT_MOST))).otherwise(noise), narrow, capped


def thresholds(df: DataFrame, segment: str, value: str, settings: Settings = Settings(), overrides: DataFrame | None = None) -> DataFrame:
    """One row a segment: n_before, the quantiles, noise_floor, lo, hi and what they were made with.

    Null and blank segments are one, DESCONHECIDO; null values don't count.  The noise quantile,
    the factor of the fence and the cap bend with the segment's kind and its shape (how heavy its
    upper tail is, how compact it is); a segment under its least size has the plain floor and
    fence.  *overrides* (segment, any of the settings, no_upper_cap) win, within bounds: a
    null setting overrides nothing, a true no_upper_cap takes the cap away.
    """
    s = settings
    df = segmented(df, segment)
    seen = grid(df, value, [segment])
    q = _overridden(nearest(df, value, FIXED, [segment], seen), segment, overrides)
    base = F.coalesce(F.greatest(F.col("o_noise_floor"), F.when(F.col("o_noise_floor").isNotNull(), F.lit(0.0))), F.lit(max(float(s.noise_floor), 0.0)))
    size = F.coalesce(F.greatest(F.floor("o_min_segment_size"), F.when(F.col("o_min_segment_size").isNotNull(), F.lit(1))), F.lit(int(s.min_segment_size))).cast("long")
    q = q.withColumns({"_base": base, "_size": size, "_mid": F.greatest(F.col("q90") - F.col("q50"), F.lit(1e-9)), "_low": F.greatest(F.col("q50") - F.col("q10"), F.lit(1e-9))})
    large = F.col("n") >= max(s.min_segment_size, LEAST_SIZE)
    q = q.withColumn("tail_ratio", F.when(large, F.greatest(F.col("q99") - F.col("q90"), F.lit(0.0)) / F.col("_mid")))
    start = (F.lit(min(max(float(s.noise_quantile), NOISE_BOUNDS[0]), NOISE_BOUNDS[1])), F.lit(float(s.iqr_factor)), _clamp(F.lit(s.upper_quantile_cap).cast("double"), CAP_BOUNDS))
    noise, factor, cap = (F.when(large, bent).otherwise(plain) for bent, plain in zip(_bent(F.col(segment), *start), start, strict=True))
    own_factor = F.greatest(F.col("o_iqr_factor"), F.when(F.col("o_iqr_factor").isNotNull(), F.lit(LEAST_FACTOR)))
    q = q.withColumns({
        "noise_quantile_used": F.coalesce(_clamp(F.col("o_noise_quantile"), NOISE_BOUNDS), _clamp(noise, NOISE_BOUNDS)),
        "iqr_factor_used": F.coalesce(own_factor, factor),
        "upper_quantile_cap_used": F.when(~F.col("o_no_cap"), F.coalesce(_clamp(F.col("o_upper_quantile_cap"), CAP_BOUNDS), cap)),
    })
    q = stash(q)
    # the two adaptive quantiles, from the same grid
    seen = seen.join(q.select(segment, "noise_quantile_used", F.coalesce("upper_quantile_cap_used", F.lit(1.0)).alias("_cap")), segment)
    q = q.join(nearest(df, value, {"_q_noise": F.col("noise_quantile_used"), "_q_cap": F.col("_cap")}, [segment], seen).drop("n"), segment)
    small = F.col("n") < F.col("_size")
    floor = F.when(small, F.col("_base")).when(F.col("_base") > 0, F.least(F.greatest(F.col("_q_noise"), F.col("_base")), 4 * F.col("_base"))).otherwise(F.greatest(F.col("_q_noise"), F.lit(0.0)))
    iqr = F.greatest(F.col("q3") - F.col("q1"), F.lit(0.0))
    fence = F.col("q3") + F.col("iqr_factor_used") * iqr
    lo = F.greatest(F.col("q1") - F.col("iqr_factor_used") * iqr, floor)
    has_cap = F.col("upper_quantile_cap_used").isNotNull() & (F.col("n") >= F.greatest(F.col("_size"), F.lit(LEAST_SIZE)))
    q_cap = F.when(has_cap, F.col("_q_cap"))
    # kept: its size is known then, so that rows that are joined to a few limits stay where they are and no task sorts a segment
    return stash(q.select(
        segment, F.col("n").alias("n_before"), floor.alias("noise_floor"), "q1", "q3", iqr.alias("iqr"), lo.alias("lo"),
        F.greatest(F.least(fence, F.coalesce(q_cap, fence)), lo).alias("hi"), fence.alias("hi_iqr"), q_cap.alias("hi_qcap"),
        "iqr_factor_used", "noise_quantile_used", "upper_quantile_cap_used", "tail_ratio",
        F.col("_size").cast("int").alias("min_segment_size_used"), small.alias("fallback_global_floor"), "manual_override",
    ))


def filtered(df: DataFrame, limits: DataFrame, segment: str, value: str) -> DataFrame:
    """Rows from lo to hi of their segment (null and blank: DESCONHECIDO's, whose name they get); null values go."""
    own = limits.select(F.col(segment), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
    return segmented(df, segment).join(own, segment).filter(F.col(value).between(F.col("_lo"), F.col("_hi"))).select(df.columns)


def accounting(df: DataFrame, limits: DataFrame, segment: str, value: str) -> DataFrame:
    """One row a segment: n_before, n_noise, n_extreme, n_after, pct_removed, kept_min, kept_max."""
    v = F.col(value)
    rows = segmented(df, segment).filter(v.isNotNull()).join(limits.select(segment, "lo", "hi", "noise_floor"), segment)
    kept = v.between(F.col("lo"), F.col("hi"))
    counts = [F.count("*").alias("n_before"), F.count_if(v < F.col("noise_floor")).alias("n_noise"), F.count_if(~kept & (v >= F.col("noise_floor"))).alias("n_extreme"), F.count_if(kept).alias("n_after")]
    out = rows.groupBy(segment).agg(*counts, F.min(F.when(kept, v)).alias("kept_min"), F.max(F.when(kept, v)).alias("kept_max"))
    return out.withColumn("pct_removed", F.round(100.0 * (F.col("n_before") - F.col("n_after")) / F.col("n_before"), 4))


def totals(account: DataFrame) -> DataFrame:
    """One row of the sums of :func:`accounting`: n_before, n_noise, n_extreme, n_after, n_removed, pct_removed."""
    counts = ["n_before", "n_noise", "n_extreme", "n_after"]
    out = account.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts]).withColumn("n_removed", F.col("n_before") - F.col("n_after"))
    return out.withColumn("pct_removed", F.coalesce(F.round(F.try_divide(100.0 * F.col("n_removed"), F.col("n_before")), 4), F.lit(0.0)))


def impact(before: DataFrame, after: DataFrame, segment: str) -> DataFrame:
    """Rows of each segment (null and blank: DESCONHECIDO) before and after, most removed first."""
    b = segmented(before, segment).groupBy(segment).agg(F.count("*").alias("n_before"))
    a = segmented(after, segment).groupBy(segment).agg(F.count("*").alias("n_after"))
    out = b.join(a, segment, "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    out = out.withColumn("removed", F.col("n_before") - F.col("n_after"))
    return out.withColumn("pct", F.round(100.0 * F.col("removed") / F.col("n_before"), 4)).orderBy(F.desc("pct"), segment)
