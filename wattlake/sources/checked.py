"""Writes that check what they write: counts, nulls and ranges are gathered while rows pass, without another look at them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row
from pyspark.sql import functions as F

from wattlake.operators.rows import RANGES, judged

VALID, REJECTED = "valid", "rejected"


def _metrics(df: DataFrame, columns: list[str], positive: list[str], ok) -> tuple[Observation, list]:
    """What is gathered of the rows for which *ok* holds, and of all of them."""
    held = [F.count_if(~ok).alias("rejected"), F.count_if(ok).alias("rows")]
    for i, c in enumerate(columns):
        held += [F.count_if(ok & F.col(f"`{c}`").isNull()).alias(f"null{i}"), F.count_if(ok & F.coalesce(F.isnan(F.col(f"`{c}`").try_cast("double")), F.lit(False))).alias(f"nan{i}")]
    held += [F.min(F.when(ok, F.col(f"`{c}`"))).alias(f"least{i}") for i, c in enumerate(positive)]
    return Observation(), held


def write(df: DataFrame, path: str, expected: list[str], positive: list[str] | None = None, ranges: tuple = RANGES) -> DataFrame:
    """Writes rows that keep all *ranges* to ``path/part=valid``, the others with their reasons to ``path/part=rejected``.

    Returns (check, passed, detail) of the valid rows, from what one pass gathered: the *expected*
    columns are there, there are rows, nothing is null or NaN in those columns, columns of *positive*
    are over 0, and no row was rejected.  The rows are read once.
    """
    lacking = [c for c in expected if c not in df.columns]
    have = [c for c in expected if c in df.columns]
    marked = judged(df, ranges)
    ok = F.size("reasons") == 0
    seen, held = _metrics(df, have, positive or [], ok)
    marked.observe(seen, *held).withColumn("part", F.when(ok, VALID).otherwise(REJECTED)).write.mode("overwrite").partitionBy("part").parquet(path)
    got = seen.get
    bad = {c: (got[f"null{i}"], got[f"nan{i}"]) for i, c in enumerate(have)}
    checks = [("columns", not lacking, ",".join(lacking)), ("rows", got["rows"] > 0, str(got["rows"])), ("complete", not any(map(sum, bad.values())), ",".join(f"{c}: {n} null, {m} NaN" for c, (n, m) in bad.items() if n or m))]
    checks += [(f"{c} positive", got[f"least{i}"] is not None and got[f"least{i}"] > 0, "") for i, c in enumerate(positive or [])]
    checks.append(("in range", got["rejected"] == 0, str(got["rejected"])))
    return df.sparkSession.createDataFrame([Row(check=a, passed=bool(b), detail=c) for a, b, c in checks], "check string, passed boolean, detail string")


def read(df_or_spark, path: str, part: str = VALID) -> DataFrame:
    """The rows of one part; those that are valid have no reasons and come without that column."""
    found = df_or_spark.read.parquet(path).filter(F.col("part") == part).drop("part")
    return found.drop("reasons") if part == VALID else found


def null_rates(df: DataFrame, path: str) -> DataFrame:
    """Writes *df* to *path* and returns (column, n_null, rate) of all its columns, gathered on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null{i}") for i, c in enumerate(df.columns)]).write.mode("overwrite").parquet(path)
    got = seen.get
    rows = [(c, got[f"null{i}"], got[f"null{i}"] / got["rows"] if got["rows"] else 0.0) for i, c in enumerate(df.columns)]
    return df.sparkSession.createDataFrame(rows, "column string, n_null long, rate double")
