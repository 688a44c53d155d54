"""Loading of a night: matching of its stars to known objects, rows of detections and catalogues, and reviews that outlive a reload."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lightloom.functions import scalar as X
from lightloom.operators import sky
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.relational import _CAT, _SEP, places
from lightloom.plans.results import detections
from lightloom.plans.statistics import r6

c = F.col

_NAME = """'RP J' || lpad((r // 36000 % 24)::VARCHAR, 2, '0') || lpad((r // 600 % 60)::VARCHAR, 2, '0') || lpad((r % 600 // 10)::VARCHAR, 2, '0') || '.' || (r % 10)::VARCHAR
  || CASE WHEN dec < 0 THEN '-' ELSE '+' END || lpad((d // 3600)::VARCHAR, 2, '0') || lpad((d // 60 % 60)::VARCHAR, 2, '0') || lpad((d % 60)::VARCHAR, 2, '0')"""


def match_stars(stars: DataFrame, objects: DataFrame, arcsec: float = 1.0) -> DataFrame:
    """(star, obj_id, name): every star (star, ra, dec) with its nearest object, which only the nearest of several claimants gets.

    The others have no object and are given a name by their place; of equal names, also those of objects, the later ones by star
    get a suffix.
    """
    won = sky.closest_wins(sky.sky_join(stars, objects, arcsec, "star", "obj_id")).select(c("l_id").alias("star"), c("r_id").alias("obj_id"))
    out = stars.join(won, "star", "left")
    fresh = out.filter("obj_id is null").select("star", X.object_name(c("ra"), c("dec")).alias("base"))
    taken = objects.select(c("name").alias("base")).distinct().withColumn("taken", F.lit(1))
    rank = F.row_number().over(Window.partitionBy("base").orderBy("star")) + F.coalesce("taken", F.lit(0))
    named = fresh.join(taken, "base", "left").withColumn("rank", rank)
    suffix = F.when(c("rank") > 1, F.concat(F.lit("-"), c("rank").cast("string"))).otherwise("")
    return out.select("star", "obj_id").join(named.select("star", F.concat("base", suffix).alias("name")), "star", "left")


@query("d3_match_stars", f"""
WITH {_CAT}, pairs AS (SELECT cat_id, obj_id, {_SEP.format(a='k', b='o')} AS sep FROM cat k JOIN pos o ON o.dec BETWEEN k.dec - 0.0003 AND k.dec + 0.0003 WHERE {_SEP.format(a='k', b='o')} <= 1),
near AS (SELECT *, row_number() OVER (PARTITION BY cat_id ORDER BY sep, obj_id) AS r FROM pairs), won AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY sep, cat_id) AS k FROM near WHERE r = 1),
fresh AS (SELECT cat_id, {_NAME} AS base FROM (SELECT cat_id, dec, floor(((CASE WHEN ra % 360 < 0 THEN (ra % 360 + 360) % 360 ELSE ra % 360 END) / 15) * 3600 * 10 + 0.5)::BIGINT AS r, floor(abs(dec) * 3600 + 0.5)::BIGINT AS d FROM cat WHERE cat_id NOT IN (SELECT cat_id FROM won WHERE k = 1))),
named AS (SELECT cat_id, base, row_number() OVER (PARTITION BY base ORDER BY cat_id) + CASE WHEN base IN (SELECT name FROM pos) THEN 1 ELSE 0 END AS n FROM fresh)
SELECT cat.cat_id AS star, won.obj_id, base || CASE WHEN n > 1 THEN '-' || n::VARCHAR ELSE '' END AS name FROM cat LEFT JOIN won ON won.cat_id = cat.cat_id AND k = 1 LEFT JOIN named ON named.cat_id = cat.cat_id""")
def _(t: Inputs) -> DataFrame:
    return match_stars(places(t).select(c("cat_id").alias("star"), "ra", "dec"), t.pos.select("obj_id", "name", "ra", "dec"))


def metrics(t: Inputs) -> DataFrame:
    """One wide row per object and night: its best dip and its best variation."""
    best = lambda kind, *more: F.max(F.when(c("kind") == kind, F.struct(F.coalesce("snr", F.lit(-1.0)).alias("k"), (-c("det_id")).alias("id"), *more)))
    rows = detections(t).filter("night_id is not null").groupBy("obj_id", "night_id")
    return rows.agg(best("transit", "snr", "depth", "tc_bjd_tdb", "duration_h", "tier", "flags", "low").alias("transit"), best("variable", "snr", "amplitude", "period").alias("variable"))


_ROW = "snr, depth, tc_bjd_tdb, duration_h, tier, flags, low, amplitude, period"


@query("d4_detection_rows", """
WITH k AS (SELECT *, row_number() OVER (PARTITION BY obj_id, night_id, kind ORDER BY coalesce(snr, -1) DESC, det_id) AS r FROM dt WHERE night_id IS NOT NULL)
SELECT obj_id, night_id, kind, round(snr, 4) AS snr, round(depth, 6) AS depth, round(tc_bjd_tdb, 6) AS tc_bjd_tdb, round(duration_h, 4) AS duration_h, tier, flags, low, NULL::DOUBLE AS amplitude, NULL::DOUBLE AS period FROM k WHERE r = 1 AND kind = 'transit'
UNION ALL SELECT obj_id, night_id, kind, round(snr, 4), NULL, NULL, NULL, NULL, NULL, NULL, round(amplitude, 6), round(period, 6) FROM k WHERE r = 1 AND kind = 'variable'""")
def _(t: Inputs) -> DataFrame:
    """A night's wide rows as detections, one row for each sort that an object shows."""
    m = metrics(t)
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    dip = F.struct(F.lit("transit").alias("kind"), *(c(f"transit.{n}").alias(n) for n in ("snr", "depth", "tc_bjd_tdb", "duration_h", "tier", "flags", "low")), none("double", "amplitude"), none("double", "period"))
    wave = F.struct(F.lit("variable").alias("kind"), c("variable.snr").alias("snr"), *(none("double", n) for n in ("depth", "tc_bjd_tdb", "duration_h")), none("int", "tier"), none("string", "flags"), none("boolean", "low"),
                    c("variable.amplitude").alias("amplitude"), c("variable.period").alias("period"))
    rows = m.select("obj_id", "night_id", F.explode(F.array_compact(F.array(F.when(c("transit").isNotNull(), dip), F.when(c("variable").isNotNull(), wave)))).alias("d")).select("obj_id", "night_id", "d.*")
    digits = {"snr": 4, "depth": 6, "tc_bjd_tdb": 6, "duration_h": 4, "amplitude": 6, "period": 6}
    return rows.select("obj_id", "night_id", "kind", *(r6(c(n), n, digits[n]) if n in digits else c(n) for n in _ROW.split(", ")))


@query("d4_catalogue_rows", """
SELECT obj_id, CASE WHEN obj_class LIKE '%EXOP%' THEN CASE WHEN known_name LIKE 'TOI%' THEN 'TOI' ELSE 'NASA Exoplanet Archive' END WHEN known_name LIKE 'Gaia DR3 %' THEN 'Gaia DR3' ELSE 'VSX/GCVS' END AS catalog, trim(known_name) AS name, nullif(known_type, '') AS type
FROM obj WHERE nullif(trim(known_name), '') IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    """Catalogue entries that a night's stars bring: planets by their list, variables by the look of their name."""
    n = c("known_name")
    planet = F.when(n.startswith("TOI"), "TOI").otherwise("NASA Exoplanet Archive")
    catalogue = F.when(c("obj_class").contains("EXOP"), planet).when(n.startswith("Gaia DR3 "), "Gaia DR3").otherwise("VSX/GCVS")
    return t.obj.filter(F.trim(n) != "").select("obj_id", catalogue.alias("catalog"), F.trim(n).alias("name"), F.when(c("known_type") != "", c("known_type")).alias("type"))


@query("d5_multinight_rows", """
WITH k AS (SELECT *, row_number() OVER (PARTITION BY obj_id, mn_run_id, kind ORDER BY coalesce(snr, -1) DESC, det_id) AS r FROM dt WHERE mn_run_id IS NOT NULL),
w AS (SELECT obj_id, mn_run_id, bool_or(kind = 'internight') AS i, bool_or(kind = 'ls_periodic') AS p, bool_or(kind = 'bls') AS b, bool_or(kind = 'recurrent') AS c FROM k GROUP BY 1, 2)
SELECT k.obj_id, k.mn_run_id, kind, CASE WHEN kind = 'bls' THEN round(snr, 4) END AS snr, CASE WHEN kind = 'bls' THEN round(tc_bjd_tdb, 6) END AS tc_bjd_tdb, CASE WHEN kind = 'ls_periodic' THEN round(0.2 + snr / 10, 6) END AS period,
  CASE WHEN kind = 'recurrent' THEN i::INT + p::INT + b::INT + c::INT END AS n_kinds FROM k JOIN w ON w.obj_id = k.obj_id AND w.mn_run_id = k.mn_run_id WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    """What a run over several nights found of an object, by kind: each kind brings its own numbers."""
    kinds = ("internight", "ls_periodic", "bls", "recurrent")
    best = lambda k: F.max(F.when(c("kind") == k, F.struct(F.coalesce("snr", F.lit(-1.0)).alias("k"), (-c("det_id")).alias("id"), "snr", "tc_bjd_tdb")))
    wide = t.det.filter("mn_run_id is not null").groupBy("obj_id", "mn_run_id").agg(*(best(k).alias(k) for k in kinds))
    seen = sum((c(k).isNotNull().cast("int") for k in kinds), F.lit(0))
    rows = [F.when(c(k).isNotNull(), F.struct(F.lit(k).alias("kind"), c(f"{k}.snr").alias("snr"), c(f"{k}.tc_bjd_tdb").alias("tc"))) for k in kinds]
    long = wide.select("obj_id", "mn_run_id", seen.alias("seen"), F.explode(F.array_compact(F.array(*rows))).alias("d")).select("obj_id", "mn_run_id", "seen", "d.*")
    only = lambda k, x: F.when(c("kind") == k, x)
    return long.select("obj_id", "mn_run_id", "kind", r6(only("bls", c("snr")), "snr", 4), r6(only("bls", c("tc")), "tc_bjd_tdb"), r6(only("ls_periodic", 0.2 + c("snr") / 10), "period"), only("recurrent", c("seen")).alias("n_kinds"))


def restore_reviews(reviews: DataFrame, events: DataFrame) -> DataFrame:
    """(review_id, det_id): saved reviews (review_id, obj_id, kind, night_id, tc) at the detections of a reload (det_id, obj_id, kind, night_id, tc, half).

    Of the same object and kind, timed ones within half the event's duration: the nearest pair of all first, each review and
    each detection once; untimed ones of the same night in order of their ids.  Reviews that find none keep a null det_id.
    An object's times fall apart into stretches without a gap that any pair could bridge; pairs are chosen within one.
    """
    key = ["obj_id", "kind"]
    timed_r, timed_e = reviews.filter("tc is not null"), events.filter("tc is not null and half > 0")
    at = Window.partitionBy(*key).orderBy(c("tc") - c("half"), "side", "id")  # stretches are unions of what each one reaches
    line = timed_r.select(*key, "tc", F.lit(0).alias("side"), c("review_id").alias("id"), F.lit(0.0).alias("half")).unionByName(timed_e.select(*key, "tc", F.lit(1).alias("side"), c("det_id").alias("id"), "half"))
    reach = F.max(c("tc") + c("half")).over(at.rowsBetween(Window.unboundedPreceding, -1))
    line = line.withColumn("new", F.coalesce(c("tc") - c("half") > reach, F.lit(True)).cast("int"))
    line = line.withColumn("part", F.sum("new").over(at.rowsBetween(Window.unboundedPreceding, 0)))
    both = line.groupBy(*key, "part").agg(F.min("side").alias("a"), F.max("side").alias("b")).filter("a < b").select(*key, "part")

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        r, e = (rows[rows["side"] == s].sort_values("tc", kind="stable") for s in (0, 1))
        near, times, wide = [], r["tc"].to_numpy(), float(e["half"].max())
        for t, d, h in zip(e["tc"], e["id"], e["half"]):
            i, j = times.searchsorted([t - wide, t + wide + 1e-12])
            near += [(abs(t - x), d, k) for x, k in zip(times[i:j], r["id"].to_numpy()[i:j]) if abs(t - x) <= h]
        used_r, used_d, out = set(), set(), []
        for _, d, k in sorted(near):
            if d not in used_d and k not in used_r:
                used_d.add(d)
                used_r.add(k)
                out.append((k, d))
        return pd.DataFrame(out, columns=["review_id", "det_id"], dtype="int64")

    timed = line.join(both, [*key, "part"], "left_semi").groupBy(*key, "part").applyInPandas(greedy, "review_id long, det_id long")
    spot = ["obj_id", "kind", "night_id"]
    order = lambda df, name: df.filter("tc is null and night_id is not null").select(*spot, name, F.row_number().over(Window.partitionBy(*spot).orderBy(name)).alias("r"))
    untimed = order(reviews, "review_id").join(order(events, "det_id"), [*spot, "r"]).select("review_id", "det_id")
    return reviews.select("review_id").join(timed.unionByName(untimed), "review_id", "left")


def _restore_sql(rounds: int) -> str:
    """The greedy choice as rounds of pairs that are each other's nearest; each round settles the nearest of what is left."""
    sql = """
e AS (SELECT det_id, obj_id, kind, night_id, tc_bjd_tdb AS t, duration_h / 48 AS h FROM det WHERE obj_id IS NOT NULL),
v AS (SELECT review_id, obj_id, kind, night_id, CASE WHEN isnan(tc_bjd_tdb) THEN NULL ELSE tc_bjd_tdb END AS tc FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY saved_at, tc_bjd_tdb) AS r FROM detection_review_orphan) WHERE r = 1 AND obj_id IS NOT NULL),
p0 AS (SELECT review_id, det_id, abs(t - tc) AS gap FROM v JOIN e USING (obj_id, kind) WHERE h > 0 AND abs(t - tc) <= h)"""
    for k in range(rounds):
        sql += f""",
m{k} AS (SELECT review_id, det_id FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY gap, det_id, review_id) AS a, row_number() OVER (PARTITION BY det_id ORDER BY gap, det_id, review_id) AS b FROM p{k}) WHERE a = 1 AND b = 1),
p{k + 1} AS (SELECT * FROM p{k} WHERE review_id NOT IN (SELECT review_id FROM m{k}) AND det_id NOT IN (SELECT det_id FROM m{k}))"""
    pairs = " UNION ALL ".join(f"SELECT review_id, det_id FROM m{k}" for k in range(rounds))
    return f"""WITH {sql.strip()}, n1 AS (SELECT review_id, obj_id, kind, night_id, row_number() OVER (PARTITION BY obj_id, kind, night_id ORDER BY review_id) AS r FROM v WHERE tc IS NULL AND night_id IS NOT NULL),
n2 AS (SELECT det_id, obj_id, kind, night_id, row_number() OVER (PARTITION BY obj_id, kind, night_id ORDER BY det_id) AS r FROM e WHERE t IS NULL AND night_id IS NOT NULL),
f AS ({pairs} UNION ALL SELECT review_id, det_id FROM n1 JOIN n2 USING (obj_id, kind, night_id, r)) SELECT review_id, det_id FROM v LEFT JOIN f USING (review_id)"""


@query("k11_review_restore", _restore_sql(8))
def _(t: Inputs) -> DataFrame:
    rows = t.table("detection_review_orphan").filter("obj_id is not null").withColumn("tc", X.clean(c("tc_bjd_tdb")))
    first = F.min(F.struct("saved_at", "tc", "obj_id", "kind", "night_id"))
    saved = rows.groupBy("review_id").agg(first.alias("v")).select("review_id", "v.obj_id", "v.kind", "v.night_id", "v.tc")
    events = t.det.filter("obj_id is not null").select("det_id", "obj_id", "kind", "night_id", c("tc_bjd_tdb").alias("tc"), (c("duration_h") / 48).alias("half"))
    return restore_reviews(saved, events)
