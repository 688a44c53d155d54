"""Products, settings, the command line, the guard of ad-hoc SQL, and the choice of frames."""

import pytest

from lightloom import __main__ as cli
from lightloom import settings
from lightloom.plans.choice import drop_frames
from lightloom.plans.search import Filters, page, predicate, read_only, run_sql
from lightloom.sources import products


def test_products(spark, tmp_path):
    stars = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "night_id int, star int")
    products.write_product({"stars": stars, "stats": stars.limit(2)}, str(tmp_path / "p"), {"a": 1})
    tables, made = products.read_product(spark, str(tmp_path / "p"))
    assert made == {"a": 1} and tables["stars"].count() == 3 and set(tables) == {"stars", "stats"}
    other = spark.createDataFrame([(1, 5), (1, 6)], "night_id int, star int")
    assert [tuple(r) for r in products.disagreements({"a": stars, "b": other}, "night_id").collect()] == [(2, 1, 0)]
    assert products.disagreements({"a": stars, "b": stars}, "night_id").count() == 0
    products.write_report(stars, str(tmp_path / "r"), "star")
    assert next((tmp_path / "r").glob("*.csv")).read_text().split() == ["night_id,star", "1,5", "1,6", "2,7"]
    (tmp_path / "n_stats.parquet").touch()
    assert products.the_one(str(tmp_path), "_stats.parquet").endswith("n_stats.parquet")
    with pytest.raises(ValueError):
        products.the_one(str(tmp_path), "_none.parquet")
    (tmp_path / "x.csv").touch()
    with pytest.raises(ValueError):
        products.companion(str(tmp_path / "x.csv"))
    (tmp_path / "x.fits").touch()
    assert products.companion(str(tmp_path / "x.csv")).endswith("x.fits") and products.companion("y.fits") == "y.fits"


def test_settings(tmp_path):
    path = tmp_path / "s.toml"
    path.write_text("[search]\nleast_snr = 7\ndurations_h = [1.0, 2.0, 3.0]\n[periods]\nlong = 2.5\n")
    got = settings.load(path)
    assert got.search.least_snr == 7.0 and got.search.durations_h == (1.0, 2.0, 3.0) and got.periods.long == 2.5 and got.matching.arcsec == 1.0
    for bad in ("[search]\nleast_snrs = 7\n", "[searching]\nx = 1\n", "search = 3\n", "[search]\nleast_snr = 'x'\n"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            settings.load(path)


def test_only_reading_statements(spark):
    spark.range(3).createOrReplaceTempView("guarded")
    for text in ("SELECT id FROM guarded", "WITH v AS (SELECT 1 AS a) SELECT a FROM v -- insert", "VALUES (1), (2)", "SELECT 'a;drop table x' AS t;"):
        assert read_only(spark, text)
    writes = ("WITH v AS (SELECT 7 AS id) INSERT INTO guarded SELECT id FROM v", "FROM guarded INSERT INTO guarded SELECT id", "DROP VIEW guarded", "CREATE TABLE t AS SELECT 1", "SELECT 1; SELECT 2",
              "INSERT INTO guarded VALUES (1)", "SET a = 1", "not sql")
    for text in writes:
        with pytest.raises(ValueError):
            read_only(spark, text)
    rows, cut = run_sql(spark, "SELECT id FROM guarded ORDER BY id DESC")
    assert [r[0] for r in rows.collect()] == [2, 1, 0] and not cut
    rows, cut = run_sql(spark, "SELECT id FROM range(6000)")
    assert rows.count() == 5000 and cut


def test_refused_values(spark):
    for bad in (Filters(classes=("X",)), Filters(status="MAYBE"), Filters(detection_kinds=("x",)), Filters(detection_scope="all")):
        with pytest.raises(ValueError):
            predicate(bad)
    for bad in ({"sort": "dropped"}, {"limit": 0}, {"limit": 1001}, {"offset": -1}):
        with pytest.raises(ValueError):
            page(spark.range(1), **bad)


def test_frames_are_dropped_for_the_poorest_tile():
    frames = list(range(10))
    assert drop_frames([(0, frozenset(), 5)], frames, 3) == ([], True)
    # Stars that lack only frame 4 decide over the many that lack more.
    assert drop_frames([(0, frozenset({4}), 3), (0, frozenset({1, 2, 3}), 9)], frames, 3) == ([4], True)
    assert drop_frames([(0, frozenset({1, 2, 3, 5}), 9)], frames, 3) == ([1, 2, 3], False)
    two = [(0, frozenset(), 3), (1, frozenset({7}), 2), (1, frozenset({8}), 2)]
    assert drop_frames(two, frames, 3) == ([7, 8], True)
    assert drop_frames([], frames, 3) == ([], False)


def test_command_line(capsys):
    assert cli.main(["list"]) == 0
    assert "d1_refresh_flags" in capsys.readouterr().out.split()
    with pytest.raises(SystemExit):
        cli.main(["run", "no_such_query", "a", "b"])
