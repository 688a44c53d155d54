import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lightloom.operators import robust, sky, store
from lightloom.sources import tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_keeps_surrogates(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, k string, v int")
    new = spark.createDataFrame([("b", 7), ("c", 8), ("d", 9)], "k string, v int")
    named = store.with_surrogate(old, new, ["k"], "id").select("id", "k", "v")
    got = {r["k"]: (r["id"], r["v"]) for r in named.collect()}
    assert got["b"] == (2, 7) and {got["c"][0], got["d"][0]} == {3, 4}
    assert rows(named) == rows(store.with_surrogate(old, new, ["k"], "id").select("id", "k", "v"))
    both = store.upsert(old, named, ["k"])
    assert both.columns == old.columns and sorted(r["k"] for r in both.collect()) == ["a", "b", "c", "d"]


def test_reload_is_idempotent_and_swaps(spark, tmp_path):
    old = spark.createDataFrame([(1, 1, "s"), (1, 2, "u"), (2, 3, "s"), (None, 4, "s")], "night int, id int, origin string")
    new = spark.createDataFrame([(1, 9, "s")], "night int, id int, origin string")
    once = store.reload(old, new, "night", F.col("origin") == "s")
    assert rows(once.dropna()) == [(1, 2, "u"), (1, 9, "s"), (2, 3, "s")] and once.count() == 4
    assert once.count() == store.reload(once, new, "night", F.col("origin") == "s").count()
    path = str(tmp_path / "t")
    store.swap_write(old, path)
    store.swap_write(once, path)
    assert spark.read.parquet(path).count() == 4 and os.listdir(tmp_path) == ["t"]


def test_fill_and_cascade(spark):
    old = spark.createDataFrame([(1, None, 2), (2, 5, None)], "k int, a int, b int")
    new = spark.createDataFrame([(1, 7, 8), (2, 7, 8)], "k int, a int, b int")
    assert rows(store.fill(old, new, "k", ["a", "b"])) == [(1, 7, 2), (2, 5, 8)]
    assert rows(store.fill(old, new, "k", ["a"], only_null=False)) == [(1, 7, 2), (2, 7, None)]
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, k int")
    assert store.cascade(child, old, "k").count() == 2
    assert rows(store.unreferenced(old, "k", [(child, "k")]).select("k")) == [(2,)]


def test_statistics_on_odd_input(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 3.0), ("c", None)], "g string, x double")
    got = {r["g"]: (r["median"], r["sigma"]) for r in robust.with_mad(df, ["g"], "x").collect()}
    assert got["a"] == (1.0, float("inf")) and abs(got["b"][1] - 1.4826) < 1e-9
    assert robust.with_mad(df.limit(0), ["g"], "x").count() == 0


def test_nearest_other_widens(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.001, 0.0), (3, 0.05, 0.0), (4, 90.0, 45.0)], "id long, ra double, dec double")
    assert [r[:2] for r in rows(sky.nearest_other(df, "id"))] == [(1, 2), (2, 1), (3, 2)]


def test_unique_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id int, name string")
    assert rows(sky.numbered_names(df, "name", "id").select("id", "name")) == [(1, "x"), (2, "x-2"), (3, "y")]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("RA,DEC,FLUX_APER_1,FLUX_APER_2,FLUXERR_APER_1,FLUXERR_APER_2\n1.5,2,10,20,1,x\n")
    got = tables.read_csv_catalog(spark, str(tmp_path / "a.csv")).first()
    assert got["RA"] == 1.5 and got["flux"] == [10.0, 20.0] and got["fluxerr"] == [1.0, None]
    spark.range(3).write.parquet(str(tmp_path / "p"))
    wide = tables.read_parquet(spark, str(tmp_path / "p"), columns={"id": "bigint", "gone": "string"})
    assert wide.columns == ["id", "gone"] and wide.filter("gone is not null").count() == 0
    assert tables.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    with pytest.raises(ValueError, match="no such columns: b"):
        tables.map_columns(spark.range(1), {"a": "b"})
    (tmp_path / "list.txt").write_text(f"# inputs\n{tmp_path}/a.csv\n\n{tmp_path}/*.csv\n")
    assert tables.expand_inputs([f"@{tmp_path}/list.txt"]) == [f"{tmp_path}/a.csv"]


def test_published_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert store.published(spark, path) is None
    store.publish(spark.range(3), path)
    first = store.published(spark, path)
    store.publish(first.unionByName(spark.range(10, 12)), path)
    assert store.published(spark, path).count() == 5 and first.count() == 3
    store.publish(spark.range(1), path)
    assert store.published(spark, path).count() == 1 and len(list((tmp_path / "t").glob("v-*"))) == 2


def test_batches_repeat_after_a_failure(spark, tmp_path):
    """A batch that had written some of its keys adds nothing to them when it runs again."""
    from lightloom.streaming.incremental import claim, merge_into, merged, recover

    def add(batch, old):
        new = batch.groupBy("k").agg(F.sum("n").alias("n"))
        return new if old is None else new.unionByName(old.join(new.select("k"), "k", "left_semi")).groupBy("k").agg(F.sum("n").alias("n"))

    path = str(tmp_path / "m")
    run = merge_into(path, ["k"], add)
    batch = lambda *r: spark.createDataFrame(r, "k int, n long")
    run(batch((1, 1), (2, 1), (2, 4)), 0)
    run(batch((2, 10)), 1)  # what a second batch wrote before it failed
    run(batch((2, 10), (3, 7)), 1)
    assert rows(merged(spark, path).select("k", "n")) == [(1, 1), (2, 15), (3, 7)]
    queue = spark.createDataFrame([(1, 5, "queued"), (2, 3, "queued"), (3, 9, "done"), (4, 3, "queued")], "req_id int, requested_at int, status string")
    assert rows(claim(queue, 2).select("req_id", "status")) == [(1, "queued"), (2, "running"), (3, "done"), (4, "running")]
    assert rows(recover(claim(queue, 2))) == rows(queue)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    data = {"a": rng.normal(size=5000), "b": np.repeat([1.0, 2.0, 3.0], [4000, 10, 1]), "c": np.array([7.0]), "d": np.arange(4.0)}
    df = spark.createDataFrame([(g, float(v)) for g, x in data.items() for v in x] + [("a", None), ("a", float("nan")), ("e", None)], "g string, x double")
    qs = [0.0, 0.1, 0.5, 0.98, 1.0]
    for accuracy in (100, 10_000):  # a coarse sketch makes wide brackets, the result is the same
        got = {r["g"]: r for r in robust.exact_quantiles(df, ["g"], "x", qs, accuracy).collect()}
        assert got.keys() == data.keys() and all(np.allclose(got[g]["q"], np.quantile(x, qs)) and got[g]["n"] == len(x) for g, x in data.items())
    everything = np.concatenate(list(data.values()))
    assert np.allclose(robust.exact_quantiles(df, [], "x", qs).first()["q"], np.quantile(everything, qs))
    assert robust.exact_quantiles(df.limit(0), ["g"], "x", qs).count() == 0
