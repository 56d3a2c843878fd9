"""Database tables read by several tasks: ranges of like size found by a probe, lists of keys in lots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.sources.tables import FETCH

#: Steps in which a probe counts a column's values, and keys of one condition.
STEPS, KEYS = 1024, 500


def quoted(name: str, url: str) -> str:
    """A column's name as it was given, in the quotes of the database that *url* names."""
    mark = "`" if url.startswith("jdbc:mysql:") else '"'
    return mark + name.replace(mark, mark * 2) + mark


def _reader(spark: SparkSession, url: str, **options: str):
    return spark.read.format("jdbc").option("url", url).option("fetchsize", FETCH).options(**options)


def _asked(spark: SparkSession, url: str, sql: str, **options: str) -> DataFrame:
    """The rows of a query that the database runs."""
    return _reader(spark, url, **options).option("query", sql).load()


def ranges(spark: SparkSession, url: str, table: str, column: str, parts: int, **options: str) -> list[str]:
    """Conditions on a whole-number column that part a table into about *parts* pieces of like size, nulls with the first.

    The database counts the column in STEPS equal steps from its least to its greatest value; what
    comes back is a row a step, whatever the table's size.  A step with more rows than a piece (a
    key in a narrow band) is probed again within itself, down to single values.
    """
    column = quoted(column, url)
    ends = _asked(spark, url, f"SELECT MIN({column}) AS LOW, MAX({column}) AS HIGH, COUNT(*) AS N FROM {table}", **options).first()
    low, high, n = ends[0], ends[1], ends[2]
    if low is None or parts < 2 or low == high:
        return ["1 = 1"]
    fair, cuts, held = -(-n // parts), [], 0

    def steps(a: int, b: int) -> list[tuple[int, int, int]]:
        """(first, after, rows) of the steps with rows from *a* to before *b*."""
        wide = max(1, -(-(b - a) // STEPS))
        counted = _asked(spark, url, f"SELECT S, COUNT(*) AS N FROM (SELECT ({column} - {a}) / {wide} AS S FROM {table} WHERE {column} >= {a} AND {column} < {b}) T GROUP BY S", **options)
        found = sorted((int(r[0]), int(r[1])) for r in counted.collect())
        return [(a + s * wide, min(a + (s + 1) * wide, b), c) for s, c in found]

    todo = steps(int(low), int(high) + 1)
    while todo:
        first, after, rows = todo.pop(0)
        if rows > fair and after - first > 1:
            todo = steps(first, after) + todo
            continue
        if held and held + rows > fair:
            cuts.append(first)
            held = 0
        held += rows
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"] if cuts else ["1 = 1"]


def read(spark: SparkSession, url: str, table: str, column: str | None = None, parts: int = 8, **options: str) -> DataFrame:
    """A table, by *column* in about *parts* pieces of like size; filters and columns are pushed to the database."""
    if column is None:
        return _reader(spark, url, **options).option("dbtable", table).load()
    found = ranges(spark, url, table, column, parts, **options)
    given = {"fetchsize": str(FETCH), **options}
    return spark.read.jdbc(url, table, predicates=found, properties=given)


def members(spark: SparkSession, url: str, table: str, column: str, keys: list, **options: str) -> DataFrame:
    """The rows whose *column* is one of *keys* (whole numbers or text), a task for each KEYS of them; the database selects.

    Each key is asked for once, null never.  No keys: no rows.
    """
    column = quoted(column, url)
    known = sorted({k for k in keys if k is not None}, key=lambda k: (str(type(k)), k))
    text = ["'" + k.replace("'", "''") + "'" if isinstance(k, str) else str(int(k)) for k in known]
    lots = [f"{column} IN ({', '.join(text[i : i + KEYS])})" for i in range(0, len(text), KEYS)] or ["1 = 0"]
    return spark.read.jdbc(url, table, predicates=lots, properties={"fetchsize": str(FETCH), **options})


def lacking(spark: SparkSession, url: str, table: str, column: str, wanted: DataFrame, **options: str) -> DataFrame:
    """Keys of *wanted* (its *column*) that the table lacks, each once: the table's column alone is read, and the join decides."""
    there = read(spark, url, table, **options).select(F.col(column).alias("_there"))
    keys = wanted.select(column).filter(F.col(column).isNotNull()).distinct()
    return keys.join(there, keys[column] == F.col("_there"), "left_anti")
