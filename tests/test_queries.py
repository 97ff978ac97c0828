"""Every registered query against its SQL in DuckDB, over the small tables."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from palimpsest.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain(v):
    """Values as both engines give them: floats by nine digits, structs and arrays as tuples."""
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    assert rows
    if name not in SQL:
        return
    found = db.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=repr)
