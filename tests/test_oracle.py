"""Every registered query with SQL gives DuckDB's rows."""

import datetime

import duckdb
import pytest

from corroborate.plans import further, indexed, registry, wider  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = db.sql(registry.ORACLES[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert ours == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=repr)
