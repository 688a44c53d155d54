import numpy as np
import pytest

from lightloom.operators.growing import closest, frame_offsets, inside_borders, match_frames, match_nights
from lightloom.sources import fits


def test_closest_claimant_has_the_match():
    to_ra, to_dec = np.array([10.0, 10.01]), np.array([0.0, 0.0])
    ra = np.array([10.0 + 0.5 / 3600, 10.0 + 0.2 / 3600, 10.01, 11.0])
    assert closest(ra, np.zeros(4), to_ra, to_dec, 1.0).tolist() == [-1, 0, 1, -1]
    assert closest(ra, np.zeros(4), to_ra[:0], to_dec[:0], 1.0).tolist() == [-1] * 4


def test_frames_of_a_night(spark):
    rng = np.random.default_rng(0)
    ra, dec, rows = rng.uniform(150, 150.3, 80), rng.uniform(-30, -29.8, 80), []
    for f in range(6):
        for k in range(80):
            if f == 0 and k >= 60:
                continue  # twenty stars appear later
            rows.append((1, f, k, float(ra[k] + rng.normal(0, 2e-5)), float(dec[k] + rng.normal(0, 2e-5))))
    rows += [(1, 3, 999, float("nan"), 0.0), (1, 3, 500, 10.0, 10.0)]
    df = spark.createDataFrame(rows, "night_id int, frame_index int, source long, ra double, dec double")
    got = match_frames(df, 1.0).collect()
    stars = {}
    for r in got:
        stars.setdefault(r["source"], set()).add(r["star"])
    assert all(len(v) == 1 for k, v in stars.items()) and len({next(iter(v)) for v in stars.values()}) == 81
    assert match_frames(df, 1.0, presence=0.8).select("star").distinct().count() == 80
    assert match_frames(df.limit(0)).count() == 0


def test_nights(spark):
    rows = [(1, 1, 10.0, 0.0), (1, 2, 10.1, 0.0), (2, 5, 10.00001, 0.0), (2, 6, 11.0, 0.0), (3, 9, 11.00001, 0.0), (3, 8, 10.1, 0.00001), (3, 7, None, 0.0)]
    df = spark.createDataFrame(rows, "night_id int, star long, ra double, dec double")
    got = {(r["night_id"], r["star"]): r["global"] for r in match_nights(df, [1, 2, 3]).collect()}
    assert got[2, 5] == got[1, 1] and got[3, 8] == got[1, 2] and got[3, 9] == got[2, 6] and len(set(got.values())) == 3 and len(got) == 6


def test_borders(spark):
    ref = spark.createDataFrame([(1, k, 40.0 + 20 * k, 500.0) for k in range(48)], "night_id int, star long, x double, y double")
    rows = [(1, f, k, 40.0 + 20 * k + 15 * f, 500.0 - f) for f in range(3) for k in range(48)] + [(1, 3, 0, 1.0, 1.0)]
    off = frame_offsets(spark.createDataFrame(rows, "night_id int, frame_index int, star long, x double, y double"), ref)
    assert sorted(tuple(r) for r in off.collect()) == [(1, 0, 0.0, 0.0), (1, 1, 15.0, -1.0), (1, 2, 30.0, -2.0)]
    inside = {r["star"]: r["inside"] for r in inside_borders(ref, off, 1000, 1000).collect()}
    assert inside[0] and inside[45] and not inside[46] and not inside[47]


def card(key, value):
    text = f"'{value}'" if isinstance(value, str) else {True: "T", False: "F"}.get(value, value) if isinstance(value, bool) else value
    return f"{key:<8}= {text:>20}".ljust(80).encode()


def header(*cards):
    raw = b"".join(card(k, v) for k, v in cards) + b"END".ljust(80)
    return raw + b" " * (-len(raw) % 2880)


@pytest.fixture
def catalogue(tmp_path):
    kind = np.dtype([("ALPHA_J2000", ">f8"), ("DELTA_J2000", ">f8"), ("X_IMAGE", ">f4"), ("Y_IMAGE", ">f4"), ("FLUX_APER", ">f4", (2,)), ("FLUXERR_APER", ">f4", (2,)), ("FLAGS", ">i2")])
    t = np.zeros(3, kind)
    t["ALPHA_J2000"], t["FLUX_APER"], t["FLAGS"] = [1.5, np.nan, 3.0], [[1, 2], [3, 4], [5, 6]], [0, 1, 4]
    forms = ["D", "D", "E", "E", "2E", "2E", "I"]
    cols = [c for k, (n, f) in enumerate(zip(kind.names, forms)) for c in ((f"TTYPE{k + 1}", n), (f"TFORM{k + 1}", f))]
    raw = t.tobytes()
    body = header(("SIMPLE", True), ("BITPIX", 16), ("NAXIS", 0), ("EXPTIME", 90.0), ("OBJECT", "O''Brien 1"))
    body += header(("XTENSION", "IMAGE"), ("BITPIX", 16), ("NAXIS", 2), ("NAXIS1", 100), ("NAXIS2", 50)) + b"\0" * (-(-10000 // 2880) * 2880)
    body += header(("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", kind.itemsize), ("NAXIS2", 3), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", 7), *cols)
    path = tmp_path / "a.fits"
    path.write_bytes(body + raw + b"\0" * (-len(raw) % 2880))
    return str(path)


def test_fits(spark, catalogue, tmp_path):
    got = fits.read_fits_sources(spark, [catalogue, catalogue]).orderBy("source").collect()
    assert [(r["source"], r["ra"], r["flux"], r["flags"]) for r in got] == [(0, 1.5, [1.0, 2.0], 0), (2, 3.0, [5.0, 6.0], 4)]
    assert fits.read_fits_headers(spark, [catalogue]).first()["header"] == {"EXPTIME": "90.0", "OBJECT": "O'Brien 1"}
    with pytest.raises(Exception, match="no such columns: NO"):
        fits.read_fits_sources(spark, [catalogue], {"x": "NO"}).collect()
    (tmp_path / "b.fits").write_bytes(b"no")
    with pytest.raises(ValueError):
        fits.read_table(str(tmp_path / "b.fits"))


def test_tiles():
    from lightloom.plans.more import tiles_of

    counts = {(x, y): 10 + x for x in range(6) for y in range(4)}
    got = tiles_of(counts, 50)
    sizes = {}
    for cell, tile in got.items():
        sizes[tile] = sizes.get(tile, 0) + counts[cell]
    assert set(got) == set(counts) and min(sizes.values()) >= 50 and len(sizes) > 1
    assert set(tiles_of({(0, 0): 3}, 50).values()) == {0} and tiles_of({}, 50) == {}
