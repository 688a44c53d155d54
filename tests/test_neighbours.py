import duckdb
import numpy as np

import __spark_entry__ as entry
from lightloom.operators.sky import k_nearest


def brute(rows, k):
    ids, ra, dec = (np.array(x) for x in zip(*rows))
    a, d = np.radians(ra), np.radians(dec)
    v = np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)
    out = {}
    for i in range(len(ids)):
        chord = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        near = [j for j in np.lexsort((ids, chord)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(chord[j])) for j in near]
    return out


def test_isolated_points_have_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(10 + rng.uniform(0, 0.02)), float(rng.uniform(0, 0.02))) for k in range(40)] + [(100, 190.0, -89.0), (101, 11.0, 0.0), (102, 200.0, 45.0)]
    df = spark.createDataFrame([*rows, (200, None, 1.0), (201, float("nan"), 0.0)], "id long, ra double, dec double")
    want = brute(rows, 7)
    for few in (0, 256):  # by rings to the end, and by comparison with all rows
        got = {}
        for r in k_nearest(df, 7, "id", few=few).orderBy("id", "rank").collect():
            got.setdefault(r["id"], []).append(r["other"])
        assert got == {k: [o for o, _ in near] for k, near in want.items()}
    assert {r["id"]: r["other"] for r in k_nearest(df, 1, "id").collect()} == {k: near[0][0] for k, near in want.items()}
    few = spark.createDataFrame(rows[:3], "id long, ra double, dec double")
    assert k_nearest(few, 7, "id").count() == 6 and k_nearest(few.limit(0), 7, "id").count() == 0


def test_every_object_has_neighbours(spark, data):
    rows = duckdb.sql(f"SELECT obj_id, ra, dec FROM '{data}/sky_object.parquet' WHERE NOT isnan(ra) AND NOT isnan(dec)").fetchall()
    want, got = brute(rows, 25), {}
    for r in entry.queries()["j9_k_nearest"](spark, data).orderBy("obj_id", "rank").collect():
        got.setdefault(r["obj_id"], []).append(r["other"])
    gaps = dict(zip((r[0] for r in rows), rows))
    assert got.keys() == gaps.keys() and all(len(x) == min(25, len(rows) - 1) for x in got.values())
    assert np.mean([got[k] == [o for o, _ in want[k]] for k in got]) > 0.99  # else ties of the last digit
    assert {r["obj_id"] for r in entry.queries()["j5_nearest_other"](spark, data).collect()} == gaps.keys()
