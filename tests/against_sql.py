"""Compare a query with its SQL on the smallest test tables."""

import math
import os

import duckdb

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connection():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return list(v) if isinstance(v, (list, tuple)) else v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


def compare(spark, query, sql):
    got = query(spark, SF)
    want = connection().execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    a, b = rows(got.columns, [tuple(r) for r in got.collect()]), rows(names, want.fetchall())
    assert len(a) == len(b) and [x for x, y in zip(a, b) if not same(x, y)] == []


def same(x, y):
    return all(p == q or isinstance(p, (int, float)) and isinstance(q, (int, float)) and math.isclose(p, float(q), rel_tol=1e-9, abs_tol=2e-6) or str(p) == str(q) for p, q in zip(x, y))
