import numpy as np

from lightloom.operators.regions import around_objects, box_outline, circle_outline, clip_ears, pairs_within, regions_containing

NAN = float("nan")
SCHEMA = "region_id long, outline string, ra_centre double, dec_centre double, radius_deg double, ra_from double, ra_to double, dec_from double, dec_to double, ra double"


def circle(k, ra, dec, r):
    return (k, "circle", ra, dec, r, NAN, NAN, NAN, NAN, 0.0)


def box(k, a, b, c, d):
    return (k, "box", NAN, NAN, NAN, a, b, c, d, 0.0)


REGIONS = [circle(1, 0.0, 90.0, 2.5), circle(2, 0.0, -90.0, 4.0), circle(3, 359.4, -69.75, 1.1), circle(4, 10.0, 88.0, 3.0), circle(5, 200.0, 10.0, 30.0),
           box(6, 359.72, 0.31, -60.0, 60.0), box(7, 351.0, 6.5, -25.0, 35.0), box(8, 10.0, 12.0, 80.0, 90.0), circle(9, 45.0, 0.0, 0.0)]


def rows(spark):
    return spark.createDataFrame(REGIONS, SCHEMA)


def test_triangles_cover_polygons():
    star = np.array([(np.cos(a) * r, np.sin(a) * r) for a, r in zip(np.linspace(0, 2 * np.pi, 11)[:-1], [2, 1] * 5)])
    for ring in (star, star[::-1], box_outline(10, 20, 0, 5), circle_outline(10, 85, 3)):
        t = clip_ears(ring)
        x, y = ring[:, 0], ring[:, 1]
        area = abs(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2
        a, b, c = t[:, 0], t[:, 1], t[:, 2]
        assert np.isclose(np.abs((b - a)[:, 0] * (c - a)[:, 1] - (b - a)[:, 1] * (c - a)[:, 0]).sum() / 2, area)


def contains(r, ra, dec):
    """Brute force: the definition of a circle and a box."""
    if r[1] == "circle":
        a, d, a0, d0 = np.radians(ra), np.radians(dec), np.radians(r[2]), np.radians(r[3])
        h = np.sin((d - d0) / 2) ** 2 + np.cos(d) * np.cos(d0) * np.sin((a - a0) / 2) ** 2
        return np.degrees(2 * np.arcsin(np.sqrt(np.clip(h, 0, 1)))) <= r[4] + 1e-9
    east = np.mod(ra - r[5], 360.0)
    return ((east <= (r[6] - r[5]) % 360 + 1e-9) | (east >= 360 - 1e-9)) & (dec >= r[7] - 1e-9) & (dec <= r[8] + 1e-9)


def test_regions_against_brute_force(spark):
    rng = np.random.default_rng(0)
    ra, dec = rng.uniform(-360, 720, 8000), np.degrees(np.arcsin(rng.uniform(-1, 1, 8000)))
    ra = np.concatenate([ra, rng.uniform(0, 360, 1500), rng.uniform(-3, 3, 2000), rng.uniform(358, 361, 500)])
    dec = np.concatenate([dec, rng.uniform(84, 90, 750), rng.uniform(-90, -84, 750), rng.uniform(-75, 60, 2000), rng.uniform(-71, -68, 500)])
    df = spark.createDataFrame([(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))], "obj_id long, ra double, dec double")
    got = [tuple(r) for r in regions_containing(df, rows(spark).repartition(3)).collect()]
    want = {(r[0], i) for r in REGIONS for i in np.flatnonzero(contains(r, ra, dec)).tolist()}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 2000


def test_containing(spark):
    points = [(1, 5.0, 89.0, "x"), (2, -0.28, 0.0, "x"), (3, 359.72, 60.0, "x"), (4, None, 1.0, "x"), (5, 10.0, NAN, "x"), (6, 360.31, -60.0, "x"),
              (7, 45.0, 0.0, "x"), (8, 20.0, -88.0, "x"), (2, -0.28, 0.0, "x"), (9, 0.3100001, 61.0, "x")]
    df = spark.createDataFrame(points, "obj_id long, ra double, dec double, region_id string")
    got = sorted({tuple(r) for r in regions_containing(df, rows(spark)).collect()})
    assert got == sorted([(1, 1), (4, 1), (6, 2), (7, 2), (6, 3), (6, 6), (9, 7), (2, 8)])
    assert regions_containing(df, rows(spark).limit(0)).count() == 0
    assert regions_containing(df.limit(0), rows(spark)).count() == 0


def test_polygon_borders_count_once(spark):
    square = spark.createDataFrame([(1, "polygon", [[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]])], "region_id long, outline string, vertices array<array<double>>")
    points = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate([(1, 1), (0, 0), (2, 1), (3, 1)])], "obj_id long, ra double, dec double")
    assert sorted(tuple(r) for r in regions_containing(points, square).collect()) == [(1, 0), (1, 1), (1, 2)]


def test_pairs_against_brute_force(spark):
    rng = np.random.default_rng(1)
    ra = np.concatenate([rng.uniform(0, 0.01, 300), 360 - rng.uniform(0, 0.005, 100), rng.uniform(0, 360, 200)])
    dec = np.concatenate([rng.uniform(-0.005, 0.005, 400), 90 - rng.uniform(0, 0.005, 200)])
    rows_ = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))]
    df = spark.createDataFrame(rows_ + rows_[:5] + [(None, 1.0, 1.0), (990, None, 1.0), (991, 1.0, NAN)], "obj_id long, ra double, dec double")
    a, d = np.radians(ra), np.radians(dec)
    v = np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], 1)
    sep = np.degrees(2 * np.arcsin(np.minimum(1, np.linalg.norm(v[:, None] - v[None], axis=2) / 2))) * 3600
    want = {(i, j) for i, j in zip(*np.where(sep <= 5)) if i < j}
    assert {(r["id_a"], r["id_b"]) for r in pairs_within(df, 5.0).collect()} == want and len(want) > 100


def test_around_objects(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 359.9999, 0.0)], "obj_id long, ra double, dec double")
    got = {tuple(r) for r in around_objects(df, rows(spark)).collect()}
    assert got == {("near", 1, 2), ("inside", 6, 1), ("inside", 7, 1), ("inside", 6, 2), ("inside", 7, 2)}


def test_repeated_and_incomplete_rows(spark):
    listed = rows(spark).unionByName(rows(spark)).unionByName(spark.createDataFrame([circle(50, NAN, 0.0, 90.0), (51, None, *REGIONS[0][2:]), (None, *REGIONS[0][1:]), (52, "heap", *REGIONS[0][2:])], SCHEMA))
    df = spark.createDataFrame([(1, 5.0, 89.0), (1, 5.0, 89.0), (None, 5.0, 89.0)], "obj_id long, ra double, dec double")
    assert sorted(tuple(r) for r in regions_containing(df, listed).collect()) == [(1, 1), (4, 1)]


def test_pairs_on_edges_of_faces(spark):
    """Neighbours across the edges and corners of the cube's faces."""
    step = 1.2e-3
    at = [(a + i * step, d + j * step) for a, d in ((45.0, 0.0), (135.0, 10.0), (45.0, 35.2643897), (225.0, -35.2643897), (0.0, 45.0), (90.0, -45.0)) for i in range(-2, 3) for j in range(-2, 3)]
    df = spark.createDataFrame([(k, float(a), float(d)) for k, (a, d) in enumerate(at)], "obj_id long, ra double, dec double")
    a, d = np.radians(np.array(at)).T
    v = np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], 1)
    sep = np.degrees(2 * np.arcsin(np.minimum(1, np.linalg.norm(v[:, None] - v[None], axis=2) / 2))) * 3600
    want = {(i, j) for i, j in zip(*np.where(sep <= 5)) if i < j}
    assert {(r["id_a"], r["id_b"]) for r in pairs_within(df, 5.0).collect()} == want and len(want) > 200
