import random

import pytest

from lightloom.llm.neartime import lost_partners, nearest_in_time

NAN = float("nan")
L, R = "id long, star long, t double, tick int, gap string", "id long, star long, t double, inside int"


def brute(left, right, tol):
    out = {}
    for i, s, t, *_ in left:
        if i is None or s is None or t is None or t != t:
            continue
        near = [(abs(t - u), j) for j, z, u, *_ in right if z == s and j is not None and u is not None and u == u and abs(t - u) <= tol]
        if near:
            out[i] = min(near)[1]
    return out


@pytest.mark.parametrize("seed,step", [(0, 1e-6), (1, 0.01), (2, 0.0003)])
def test_brute_force(spark, seed, step):
    rng = random.Random(seed)
    at = lambda: 2454100 + round(rng.uniform(0, 1.5) / step) * step
    star = lambda: rng.choice([1, 1, 1, 2, 3, 4])  # noqa: E731 - one star has half of all rows
    left = [(i, star(), at(), 0, "") for i in range(400)]
    right = [(1000 + i, star(), at(), 0) for i in range(400)]
    left += left[:9] + [(900, None, at(), 0, ""), (901, 1, None, 0, ""), (902, 1, NAN, 0, ""), (None, 1, at(), 0, ""), (903, 1, float("inf"), 0, "")]
    right += right[:9] + [(2000, 1, None, 0), (2001, 1, NAN, 0), (None, 1, at(), 0), (2002, None, at(), 0)]
    got = nearest_in_time(spark.createDataFrame(left, L), spark.createDataFrame(right, R), ["star"], "id", "t", "id", "t", 0.05).collect()
    mine = {r["left_id"]: r["right_id"] for r in got}
    assert len(got) == len(mine)
    dist = lambda pairs: {i: round(abs(dict((x[0], x[2]) for x in left)[i] - dict((x[0], x[2]) for x in right)[j]), 9) for i, j in pairs.items()}
    want = brute(left, right, 0.05)
    assert dist(mine) == dist(want) and (step < 1e-5 or sum(mine[i] != want[i] for i in mine) <= 0.02 * len(mine))


def test_ties_take_the_least_id(spark):
    left = spark.createDataFrame([(1, 1, 10.0, 0, "")], L)
    right = spark.createDataFrame([(7, 1, 10.25, 0), (5, 1, 10.25, 0), (6, 1, 9.75, 0), (9, 1, 10.25, 0)], R)
    assert [tuple(r) for r in nearest_in_time(left, right, ["star"], "id", "t", "id", "t", 0.5).collect()] == [(1, 5, 0.25)]
    assert nearest_in_time(left, right, ["star"], "id", "t", "id", "t", 0.2).count() == 0
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        assert nearest_in_time(a, b, ["star"], "id", "t", "id", "t", 0.5).count() == 0


def test_query(spark):
    shapes = spark.createDataFrame([(1, 5, 100.0)], "shape_id long, obj_id long, tc double")
    dets = spark.createDataFrame([(11, 5, 3, "transit", 100.04), (11, 5, 3, "transit", 100.04), (12, 5, 3, "variable", 100.001)], "det_id long, obj_id long, night_id int, kind string, tc_bjd_tdb double")
    frames = spark.createDataFrame([(21, 3, 100.035), (22, 3, 100.2), (23, 4, 100.04)], "frame_id long, night_id int, bjd_tdb double")
    assert sorted(tuple(r) for r in lost_partners(shapes, dets, frames).collect()) == [("detection_frame", 11, 21), ("shape_detection", 1, 11)]


def test_crowded_ticks_and_no_tolerance(spark):
    """Thousands of times within one tick, in lumps and alone, and equal times only."""
    rng = random.Random(4)
    left = [(i, 1, 5.0 + rng.choice([0.001, 0.002, 0.0051]) + rng.random() * 1e-4, 0, "") for i in range(300)]
    right = [(1000 + i, 1, 5.0 + rng.choice([0.0005, 0.002, 0.006]) + rng.random() * 1e-4, 0) for i in range(3000)] + [(9000, 1, 5.0045, 0)]
    got = {r["left_id"]: r["right_id"] for r in nearest_in_time(spark.createDataFrame(left, L), spark.createDataFrame(right, R), ["star"], "id", "t", "id", "t", 0.05).collect()}
    assert got == brute(left, right, 0.05)
    same = [(i, 1, 2454100.0 + i * 0.25, 0, "") for i in range(50)], [(1000 + i, 1, 2454100.0 + i * 0.5, 0) for i in range(50)]
    got = {r["left_id"]: r["right_id"] for r in nearest_in_time(spark.createDataFrame(same[0], L), spark.createDataFrame(same[1], R), ["star"], "id", "t", "id", "t", 0.0).collect()}
    assert got == {i: 1000 + i // 2 for i in range(0, 50, 2)}
