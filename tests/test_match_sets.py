import duckdb

import __spark_entry__ as entry
from lightloom.operators.growing import match_sets


def test_sets_run_side_by_side(spark):
    """Two sets at the same place keep lists of their own; the closest claimant has a match; nights go over batches."""
    rows = [("a", 1, 1, 1, 10.0, 0.0), ("a", 2, 2, 5, 10.0001, 0.0), ("a", 2, 2, 6, 10.0002, 0.0), ("a", 3, 3, 7, 10.0002, 0.0), ("b", 1, 9, 1, 10.0, 0.0), ("b", 2, 8, 2, 11.0, 0.0), ("b", 2, 8, 3, None, 0.0), ("b", 2, 8, 4, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "set string, step int, night_id int, star long, ra double, dec double")
    want = {("a", 1, 1): 0, ("a", 2, 5): 0, ("a", 2, 6): 1, ("a", 3, 7): 1, ("b", 9, 1): 0, ("b", 8, 2): 1}
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (kept, "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert {(r["set"], r["night_id"], r["star"]): r["global"] for r in match_sets(df).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert match_sets(df.limit(0)).count() == 0


def test_every_target_is_tied(spark, data):
    got = entry.queries()["j11_match_nights"](spark, data).collect()
    seen = duckdb.sql(f"""SELECT DISTINCT target, night_id, star_id FROM '{data}/matched_epoch.parquet' JOIN '{data}/night.parquet' AS night USING (night_id) JOIN '{data}/sky_object.parquet' ON obj_id = star_id
      WHERE night.removed_at IS NULL AND flux > 0 AND NOT isnan(flux) AND NOT isinf(flux) AND fluxerr > 0 AND NOT isnan(fluxerr) AND NOT isinf(fluxerr) AND NOT isnan(ra) AND NOT isnan(dec)""").fetchall()
    nights, pairs = {n for _, n, _ in seen}, {(r["target"], r["night_id"], r["star"]) for r in got}
    assert len(pairs) == len(got) and pairs <= set(seen) and {r["night_id"] for r in got} == nights and len({x[0] for x in pairs}) == len({x[0] for x in seen})
    # A night's stars have different ids; one object is one star of its target, unless a nearer claimant has it.
    assert len({(r["target"], r["night_id"], r["global"]) for r in got}) == len(got)
    assert len({(r["target"], r["global"]) for r in got}) <= len({(r["target"], r["star"]) for r in got})
