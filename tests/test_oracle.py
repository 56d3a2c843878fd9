"""Every registered query with SQL gives the rows that DuckDB gives for it."""

import datetime
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float):
        return repr(x + 0.0)
    if isinstance(x, (datetime.date, datetime.datetime)):
        return str(x)
    return x


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sf_dir, name):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    mine = entry.queries()[name](spark, sf_dir)
    theirs = c.sql(entry.oracle_sql()[name])
    assert sorted(mine.columns) == sorted(theirs.columns)
    at = [theirs.columns.index(k) for k in sorted(theirs.columns)]
    want = sorted(repr(tuple(plain(r[i]) for i in at)) for r in theirs.fetchall())
    assert sorted(repr(tuple(plain(r[k]) for k in sorted(mine.columns))) for r in mine.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_availability_of_several_units_repeats(spark, tmp_path):
    """Users beyond 9999 share a device id, so a device has availability of several units on one day, and each of these rows repeats consumption."""
    event = "select i as event_id, timestamp '2024-01-12 00:00:00' + to_hours(i % 240) as ts, 12340 + i % 3 * 7 as user_id, 'click' as event_type, 5.0::double as value, '{}' as props"
    duckdb.connect().sql(f"copy ({event} from range(1200) t(i)) to '{tmp_path}/events.parquet'")
    c = duckdb.connect()
    c.sql(f"create view events as select * from '{tmp_path}/events.parquet'")
    theirs = c.sql(entry.oracle_sql()["consolidate_direct_repeated"])
    names, want = sorted(theirs.columns), theirs.fetchall()
    at = [theirs.columns.index(k) for k in names]
    got = entry.queries()["consolidate_direct_repeated"](spark, str(tmp_path)).collect()
    assert sorted(repr(tuple(plain(r[k]) for k in names)) for r in got) == sorted(repr(tuple(plain(r[i]) for i in at)) for r in want)
    assert len(want) > 2 * entry.queries()["consolidate_direct"](spark, str(tmp_path)).count()  # else the test shows nothing
