import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from lightloom.plans.registry import Inputs
from lightloom.plans.relational import places


def degrees(text, unit):
    part = [float(x) for x in re.findall(r"[0-9]+(?:\.[0-9]*)?", text)]
    value = part[0] if len(part) == 1 else unit * (part[0] + part[1] / 60 + part[2] / 3600)
    return -value if text.strip().startswith("-") else value


def separation(a, b):
    u, v = ([math.cos(math.radians(d)) * math.cos(math.radians(r)), math.cos(math.radians(d)) * math.sin(math.radians(r)), math.sin(math.radians(d))] for r, d in (a, b))
    return math.degrees(2 * math.asin(min(1, math.dist(u, v) / 2))) * 3600


def test_notations(spark, tmp_path):
    texts = [("00:38:45.74", "-00 30 00"), ("0h38m45.74s", "-00d30m00s"), ("00 38 45.74", "-0.5"), ("9.690583333333333", "-00:30:00.0"), ("?", "1.5"), (None, None), ("10:20", "5.0")]
    spark.createDataFrame([(k, *x) for k, x in enumerate(texts)], "cat_id long, ra_text string, dec_text string").write.parquet(str(tmp_path / "catalog_source.parquet"))
    got = {r["cat_id"]: (r["ra"], r["dec"]) for r in places(Inputs(spark, str(tmp_path))).collect()}
    assert got.keys() == {0, 1, 2, 3} and all(abs(ra - 9.690583333333333) < 1e-9 and abs(dec + 0.5) < 1e-12 for ra, dec in got.values())


@pytest.fixture(scope="module")
def pairs(data):
    """All pairs within five arcsec by brute force, over every row with a place."""
    c = duckdb.connect()
    cat = [(k, degrees(ra, 15), degrees(dec, 1)) for k, ra, dec in c.execute(f"SELECT cat_id, ra_text, dec_text FROM '{data}/catalog_source.parquet' WHERE ra_text IS NOT NULL AND dec_text IS NOT NULL").fetchall()]
    obj = c.execute(f"SELECT obj_id, ra, dec FROM '{data}/sky_object.parquet' WHERE NOT isnan(ra) AND NOT isnan(dec)").fetchall()
    near = [(k, o, separation((ra, dec), (x, y))) for k, ra, dec in cat for o, x, y in obj if abs(dec - y) < 0.0014]
    return [p for p in near if p[2] <= 5]


def test_every_place_is_matched(spark, data, pairs):
    run = lambda name: entry.queries()[name](spark, data).collect()
    nearest, cats = {}, {}
    for k, o, sep in sorted(pairs, key=lambda p: (p[2], p[1])):
        nearest.setdefault(k, (o, sep))
        cats.setdefault(o, []).append(k)
    got = {r["cat_id"]: (r["obj_id"], r["sep"]) for r in run("j1_sky_nearest")}
    assert got.keys() == nearest.keys() and all(got[k][0] == o and abs(got[k][1] - sep) < 1e-3 for k, (o, sep) in nearest.items())
    winners = {}
    for k, (o, sep) in nearest.items():
        winners[o] = min(winners.get(o, (math.inf, k)), (sep, k))
    assert {(r["cat_id"], r["obj_id"]) for r in run("j2_j10_closest_wins")} == {(k, o) for o, (_, k) in winners.items()}
    assert {r["obj_id"]: (r["n"], r["cats"]) for r in run("j6_radius_all")} == {o: (len(k), sorted(k)) for o, k in cats.items()}
    # The SQL reads the notations too.
    c = duckdb.connect()
    for name in ("catalog_source", "sky_object"):
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{name}.parquet')")
    told = {k: (o, sep) for k, o, sep in c.execute(entry.oracle_sql()["j1_sky_nearest"]).fetchall()}
    assert told.keys() == got.keys() and all(got[k][0] == o and abs(got[k][1] - sep) < 1e-3 for k, (o, sep) in told.items())
