import random

from pyspark.sql import functions as F

from lightloom.llm.entities import Matching, degrees_from_text, match_entities, name_key, number_digits

ROWS = "cat_id long, catalog string, designation string, alias string, source_ref string, ra_text string, dec_text string, gmag double, ra double, p double"
THINGS = "obj_id long, ra double, dec double, gaia_id string, known_name string, mean_mag float, f_sep double"


def test_names(spark):
    same = [("V346 Ind", "Ind V0346", "V*346 IND", "V 346 ind", "V346Ind", "Ind V0346 (var)"), ("KVS 106625", "KVS no. 106625", "kvs-0106625", "KVS J106625", "K.V.S. 106625"),
            ("NVL-1073.02", "N.V.L. 1073.02", "NVL_1073.02", "nvl 1073-02", "NVL-1073.02*")]
    for group in same:
        keys = {r[0] for r in spark.createDataFrame([(x,) for x in group], "x string").select(name_key(F.col("x"))).collect()}
        assert len(keys) == 1, (group, keys)
    odd = spark.createDataFrame([("V461 Cam",), ("V461 CMa",), ("",), (None,), ("?",), ("12",)], "x string").select(name_key(F.col("x")).alias("k")).collect()
    assert odd[0]["k"] != odd[1]["k"] and all(r["k"] is None for r in odd[2:])


def test_places_and_numbers(spark):
    df = spark.createDataFrame([("22h04m15.24s",), ("22:04:15.24",), ("22 04 15.24",), ("331.0635",), ("-00 30 00",), ("what",), (None,)], "x string")
    got = [r[0] for r in df.select(degrees_from_text(F.col("x"), True)).collect()]
    assert all(abs(x - 331.0635) < 1e-6 for x in got[:4]) and abs(got[4] + 7.5) < 1e-9 and got[5:] == [None, None]
    df = spark.createDataFrame([("Gaia DR3 7188300358323757142",), ("7578589913073139235 ",), ("73271320007100...",), ("7.006480043161e+18",), ("819798x2x9122",), ("12",), (None,)], "x string")
    assert [r[0] for r in df.select(number_digits(F.col("x"))).collect()] == ["7188300358323757142", "7578589913073139235", "73271320007100", "700648004316", "819798x2x9122", None, None]


def test_matching(spark):
    rng = random.Random(5)
    things, rows, truth = [], [], {}
    for i in range(300):
        ra, dec, mag, gaia = rng.uniform(100, 103), rng.uniform(-40, -38), rng.uniform(11, 17), str(rng.randrange(6 * 10**18, 9 * 10**18))
        name = f"V{300 + i} Ind" if i % 3 == 0 else None
        things.append((i, ra, dec, gaia, name, mag, 0.0))
        if i % 2:
            continue
        place = rng.random() < 0.8
        has_name, has_ref = name is not None, rng.random() < 0.6
        if not (place or has_name or has_ref):
            place = True
        ref = gaia[:14] + "..." if rng.random() < 0.5 else gaia[:5] + "x" + gaia[6:]
        rows.append((1000 + i, "C", f"Ind V0{300 + i}" if has_name else None, None, ref if has_ref else str(rng.randrange(6 * 10**18, 9 * 10**18)) if rng.random() < 0.3 else None,
                     f"{ra + rng.gauss(0, 1e-4):.5f}" if place else None, f"{dec + rng.gauss(0, 1e-4):.5f}" if place else None, mag + rng.gauss(0.2, 0.1), 0.0, 0.0))
        truth[1000 + i] = i
    for j in range(60):  # stars that are not there
        rows.append((5000 + j, "C", f"V{900 + j} Ind", None, None, f"{rng.uniform(100, 103):.5f}", f"{rng.uniform(-40, -38):.5f}", 14.0, 0.0, 0.0))
    rows += rows[:3] + [(7000, "C", None, None, None, None, None, None, None, None), (None, "C", "V300 Ind", None, None, None, None, None, None, None)]
    things += [things[0], (None, 100.0, -39.0, None, None, 12.0, 0.0), (8000, None, float("nan"), "", "", float("nan"), 0.0)]
    a, b = spark.createDataFrame(rows, ROWS), spark.createDataFrame(things, THINGS)
    got = {r["cat_id"]: (r["obj_id"], r["confidence"]) for r in match_entities(a, b).collect()}
    right = sum(truth.get(k) == v for k, (v, _) in got.items())
    assert right >= 0.97 * len(truth) and right >= 0.99 * len(got) and all(0.5 < p <= 1 for _, p in got.values())
    assert match_entities(a.limit(0), b).count() == 0 and match_entities(a, b.limit(0)).count() == 0


def test_shared_names_prove_nothing(spark):
    things = spark.createDataFrame([(i, None, None, None, "V300 Ind", None, 0.0) for i in range(200)], THINGS)
    rows = spark.createDataFrame([(1, "C", "V300 Ind", None, None, None, None, None, 0.0, 0.0)], ROWS)
    assert match_entities(rows, things).count() == 0


QUICK = Matching(rounds=3)


def one_row(spark, **values):
    row = dict.fromkeys([c.split()[0] for c in ROWS.split(", ")]) | {"cat_id": 1, "catalog": "C"} | values
    return spark.createDataFrame([tuple(row.values())], ROWS)


def test_magnitude_tells_crowded_names_apart(spark):
    """Sixty things of one name, of which one has the row's magnitude and the others are two magnitudes off."""
    for n in (40, 60):
        things = spark.createDataFrame([(i, None, None, None, "V300 Ind", 13.0 if i == 17 else 11.0 + 0.001 * (i % 7), 0.0) for i in range(n)], THINGS)
        got = match_entities(one_row(spark, designation="V300 Ind", gmag=13.2), things, QUICK).collect()
        assert [(r["cat_id"], r["obj_id"]) for r in got] == [(1, 17)] and (n == 40 or got[0]["confidence"] > 0.9)
    alike = spark.createDataFrame([(i, None, None, None, "V300 Ind", 13.0 + 0.0001 * i, 0.0) for i in range(500)], THINGS)
    assert match_entities(one_row(spark, designation="V300 Ind", gmag=13.2), alike, QUICK).count() == 0


def test_crowded_stretches_of_numbers(spark):
    things = spark.createDataFrame([(i, None, None, f"868174962{i:010d}", None, 13.0, 0.0) for i in range(3000)] + [(9999, None, None, "1" * 30, None, 13.0, 0.0)], THINGS)
    for ref in ("8681749620000002345", "868174962000000234...", "86817496200x0002345"):
        got = {r["obj_id"] for r in match_entities(one_row(spark, source_ref=ref), things, QUICK).collect()}
        assert got <= {2345}, ref
    # The last digits count for every number that is whole, however long other numbers are.
    got = match_entities(one_row(spark, source_ref="x681749620000002345", gmag=13.2), things, QUICK).collect()
    assert [r["obj_id"] for r in got] == [2345]


def test_rows_of_one_thing_must_be_alike(spark):
    """Two rows claim a thing by its name; one of them lies elsewhere and is not like the surer one."""
    things = spark.createDataFrame([(i, 100.0 + i, -30.0, None, f"V{400 + i} Ind", 13.0, 0.0) for i in range(30)] + [(50, None, None, None, "V900 Ind", 13.0, 0.0)], THINGS)
    rows = [(100 + i, "C", f"V{400 + i} Ind", None, None, f"{100.0 + i:.5f}", "-30.00000", 13.2, 0.0, 0.0) for i in range(30)]
    twice = [(1, "C", "V900 Ind", None, None, "200.00000", "10.00000", 13.2, 0.0, 0.0), (2, "C", "V900 Ind", None, None, "200.00010", "10.00010", 13.2, 0.0, 0.0)]
    far = [(1, "C", "V900 Ind", None, None, "200.00000", "10.00000", 13.2, 0.0, 0.0), (2, "C", "V900 Ind", None, None, "20.00000", "-60.00000", 13.9, 0.0, 0.0)]
    run = lambda more: {r["cat_id"] for r in match_entities(spark.createDataFrame(rows + more, ROWS), things, QUICK).collect() if r["obj_id"] == 50}
    assert run(twice) == {1, 2} and run(far) == {1}


def test_crowded_keys_leave_no_candidate_out(spark):
    """Of many things of one name, one is told by its number alone: read with gaps at both ends, with and without magnitudes."""
    number = lambda i: f"{(i * 7919 + 13) * 10**13 + (i * 104729) % 10**13:019d}"
    for n, block in ((60, 1000), (60, 20)):
        things = spark.createDataFrame([(i, None, None, number(i), "V300 Ind", 11.0 + 0.01 * i, 0.0) for i in range(n)], THINGS)
        ref = "x" + number(41)[1:-1] + "x"
        for mag in (None, 11.0 + 0.01 * 20):
            got = match_entities(one_row(spark, designation="V300 Ind", source_ref=ref, gmag=mag), things, Matching(rounds=3, block=block)).collect()
            assert [r["obj_id"] for r in got] == [41], (block, mag)
