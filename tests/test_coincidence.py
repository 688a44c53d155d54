import math

import duckdb
import numpy as np

import __spark_entry__ as entry
from lightloom.functions.scalar import binomial_sf_values


def exact(k, n, p):
    return math.fsum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k, n + 1))


def test_chance_of_any_count():
    cases = [(k, n, p) for n in (1, 2, 7, 60, 400) for k in sorted({0, 1, 2, 3, n // 2, n}) if k <= n for p in (1e-4, 0.03, 0.5, 0.97)]
    got = binomial_sf_values(*np.array(cases, float).T)
    assert np.allclose(got, [exact(*x) for x in cases], rtol=1e-9, atol=1e-13)
    assert binomial_sf_values([2, 3, 1, 1], [2, 2, 9, 9], [1.0, 0.5, 0.0, np.nan])[:3].tolist() == [1.0, 0.0, 0.0]
    # A long night: the middle of a symmetric distribution, and a tail far below one.
    mid, tail = binomial_sf_values([50_001, 40], [100_001, 100_000], [0.5, 1e-4])
    assert abs(mid - 0.5) < 1e-9 and 0 < tail < 1e-8


def test_events_with_many_lookalikes_stay(spark, data):
    """Every timed event has a chance, however many look-alikes it has, and it is the SQL's and the exact one."""
    got = {r["det_id"]: r["p_chance"] for r in entry.queries()["x25_coincidence_chance"](spark, data).collect()}
    seen = {r["det_id"]: r for r in entry.queries()["j23_g13_coincidence"](spark, data).collect()}
    assert got.keys() == seen.keys() and max(r["n_similar"] for r in seen.values()) >= 3
    c = duckdb.connect()
    for name in ("detection", "frame"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    told = dict(c.execute(entry.oracle_sql()["x25_coincidence_chance"]).fetchall())
    assert told.keys() == seen.keys() and all(abs(got[k] - v) < 1.1e-5 for k, v in told.items())
    for k, r in seen.items():
        n, m = r["n_similar"], r["m"]
        assert abs(got[k] - (exact(n, m, r["n_expected"] / m) if m else 1)) < 1e-3
        assert r["rejected"] == (n >= 3 and got[k] < 1e-3) or abs(got[k] - 1e-3) < 1e-5
