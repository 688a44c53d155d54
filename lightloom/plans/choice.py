"""Queries that choose: catalogue values of objects, stars of all first nights, series worth a period, frames worth keeping."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lightloom.operators import sky
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.relational import _CAT, _SEP, places
from lightloom.plans.results import star_nights
from lightloom.plans.statistics import r6

c = F.col


def near_catalogue(t: Inputs, arcsec: float) -> DataFrame:
    """(obj_id, cat_id, sep, designation, var_type) of all catalogue rows within a radius of an object."""
    pairs = sky.sky_join(places(t), t.pos, arcsec, "cat_id", "obj_id").select(c("r_id").alias("obj_id"), c("l_id").alias("cat_id"), c("sep_arcsec").alias("sep"))
    return pairs.join(t.table("catalog_source").select("cat_id", "designation", "var_type"), "cat_id")


_NEAR = f"""{_CAT}, near AS (SELECT o.obj_id, k.cat_id, {_SEP.format(a='k', b='o')} AS sep, designation, var_type FROM cat k JOIN pos o ON o.dec BETWEEN k.dec - 0.0014 AND k.dec + 0.0014 JOIN catalog_source s ON s.cat_id = k.cat_id
  WHERE {_SEP.format(a='k', b='o')} <= {{}})"""


@query("j6_merged_values", "WITH " + _NEAR.format(5) + """, ty AS (SELECT obj_id, var_type, min(cat_id) AS f FROM near WHERE var_type IS NOT NULL GROUP BY 1, 2)
SELECT n.obj_id, arg_min(designation, cat_id) AS name, any_value(types) AS types FROM near n LEFT JOIN (SELECT obj_id, string_agg(var_type, '|' ORDER BY f) AS types FROM ty GROUP BY 1) y ON y.obj_id = n.obj_id GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    """What the catalogue says of each object, of all rows near it: the first name there is, every type once in order of appearance."""
    rows = near_catalogue(t, 5.0)
    name = rows.groupBy("obj_id").agg(F.min(F.when(c("designation").isNotNull(), F.struct("cat_id", "designation"))).alias("n")).select("obj_id", c("n.designation").alias("name"))
    kinds = rows.filter("var_type is not null").groupBy("obj_id", "var_type").agg(F.min("cat_id").alias("f"))  # a few types an object
    kinds = kinds.groupBy("obj_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "var_type"))), lambda x: x["var_type"]), "|").alias("types"))
    return name.join(kinds, "obj_id", "left")


@query("j7_known_variables", "WITH " + _NEAR.format(2) + """, r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY sep, cat_id) AS r FROM near WHERE var_type IS NOT NULL)
SELECT o.obj_id, r.obj_id IS NOT NULL AS known_variable, r.cat_id, var_type, round(sep, 4) AS sep FROM pos o LEFT JOIN r ON r.obj_id = o.obj_id AND r = 1""")
def _(t: Inputs) -> DataFrame:
    """Whether each object is a variable of the catalogue, and the nearest entry that says so."""
    best = near_catalogue(t, 2.0).filter("var_type is not null").groupBy("obj_id").agg(F.min(F.struct("sep", "cat_id", "var_type")).alias("b"))
    return t.pos.select("obj_id").join(best, "obj_id", "left").select("obj_id", c("b").isNotNull().alias("known_variable"), "b.cat_id", "b.var_type", r6(c("b.sep"), "sep", 4))


@query("j30_majority_mapping", "WITH " + _NEAR.format(5) + """, x AS (SELECT DISTINCT cat_id AS g, night_id, near.obj_id FROM near JOIN sn ON sn.obj_id = near.obj_id), a AS (SELECT g, min(night_id) AS anchor FROM x GROUP BY 1),
v AS (SELECT g, obj_id, count(*) AS n, bool_or(night_id = anchor) AS at_anchor FROM x JOIN a USING (g) GROUP BY 1, 2), w AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, at_anchor DESC, obj_id) AS r, count(*) OVER (PARTITION BY g) AS claims FROM v)
SELECT g, obj_id, n, claims, (SELECT count(DISTINCT night_id) FROM x WHERE x.g = w.g) - n AS conflicts FROM w WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    """Which object each catalogue star is, by the nights in which one of the objects near it was seen: most nights, else the first night's, else
    the least id; nights that only others claim are in conflict."""
    near = near_catalogue(t, 5.0).select(c("cat_id").alias("g"), "obj_id").distinct()
    x = near.join(star_nights(t).select("obj_id", "night_id"), "obj_id")
    whole = x.groupBy("g").agg(F.min("night_id").alias("anchor"), F.countDistinct("night_id").alias("nights"), F.countDistinct("obj_id").alias("claims"))
    v = x.join(whole, "g").groupBy("g", "obj_id", "nights", "claims").agg(F.count("*").alias("n"), F.bool_or(c("night_id") == c("anchor")).alias("at_anchor"))
    best = v.groupBy("g", "nights", "claims").agg(F.max(F.struct("n", "at_anchor", (-c("obj_id")).alias("o"))).alias("b"))
    return best.select("g", (-c("b.o")).alias("obj_id"), "b.n", "claims", (c("nights") - c("b.n")).alias("conflicts"))


@query("a12_a13_aperture_of_bins", """
WITH st AS (SELECT night_id, star_id, aper, median(flux) AS med FROM ep GROUP BY 1, 2, 3), x AS (SELECT e.night_id, e.star_id, e.aper, flux / med AS x, med FROM ep e JOIN st USING (night_id, star_id, aper)),
m AS (SELECT night_id, star_id, aper, median(x) AS mx, any_value(med) AS med FROM x GROUP BY 1, 2, 3), s AS (SELECT x.night_id, x.star_id, x.aper, 1.4826 * median(abs(x - mx)) AS rms, any_value(m.med) AS med FROM x JOIN m USING (night_id, star_id, aper) GROUP BY 1, 2, 3),
b AS (SELECT night_id, star_id, aper, rms, round(-2.5 * log10(med))::BIGINT AS bin FROM s), k AS (SELECT night_id, bin, aper, median(rms) AS r FROM b WHERE rms > 0 GROUP BY 1, 2, 3),
best AS (SELECT night_id, bin, arg_min(aper, (r, aper)) AS aper FROM k GROUP BY 1, 2), own AS (SELECT night_id, star_id, min(bin) AS bin FROM b GROUP BY 1, 2),
n AS (SELECT own.night_id, star_id, best.aper, row_number() OVER (PARTITION BY own.night_id, star_id ORDER BY abs(best.bin - own.bin), best.bin) AS r FROM own JOIN best ON best.night_id = own.night_id) SELECT night_id, star_id, aper FROM n WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    """Each star's aperture: the one of least median scatter among the stars of its night and brightness, or of the nearest brightness (the brighter
    of two) that tells."""
    from lightloom.operators import robust as R
    from lightloom.plans.statistics import STAR, normalised, star_stats

    level = normalised(t).groupBy(*STAR).agg(F.first("med").alias("med"))
    b = star_stats(t).select(*STAR, "rms").join(level, STAR).withColumn("bin", F.round(-2.5 * F.log10("med")).cast("long"))
    k = b.filter("rms > 0").groupBy("night_id", "bin", "aper").agg(R.median("rms").alias("r"))
    best = k.groupBy("night_id", "bin").agg(F.min(F.struct("r", "aper")).alias("m"))
    bins = best.groupBy("night_id").agg(F.collect_list(F.struct("bin", c("m.aper").alias("aper"))).alias("bins"))  # a few bins a night
    own = b.groupBy("night_id", "star_id").agg(F.min("bin").alias("bin")).join(bins, "night_id")
    near = F.array_min(F.transform("bins", lambda x: F.struct(F.abs(x["bin"] - c("bin")).alias("off"), x["bin"].alias("b"), x["aper"].alias("aper"))))
    return own.select("night_id", "star_id", near["aper"].alias("aper"))


@query("j12_stars_of_first_nights", """
WITH n AS (SELECT target, night_id, dense_rank() OVER (PARTITION BY target ORDER BY night_id) AS r, count(*) OVER (PARTITION BY target) AS k FROM night WHERE target IS NOT NULL)
SELECT target, obj_id FROM sn JOIN n USING (night_id) WHERE r <= 2 AND k >= 2 GROUP BY 1, 2 HAVING count(*) = 2""")
def _(t: Inputs) -> DataFrame:
    """Stars that both of a target's first two nights have: what a match of further nights starts from."""
    w = Window.partitionBy("target")
    n = t.night.filter("target is not null").select("target", "night_id", F.row_number().over(w.orderBy("night_id")).alias("r"), F.count("*").over(w).alias("k")).filter("r <= 2 and k >= 2")
    return star_nights(t).join(n, "night_id").groupBy("target", "obj_id").agg(F.count("*").alias("m")).filter("m = 2").select("target", "obj_id")


@query("f19_series_worth_a_period", """
WITH n AS (SELECT obj_id, count(*) AS nights, sum(n_epochs) AS epochs FROM sn GROUP BY 1), d AS (SELECT obj_id, bool_or(kind = 'variable') AS v, bool_or(kind = 'internight') AS i, bool_or(kind = 'recurrent') AS r FROM det GROUP BY 1)
SELECT n.obj_id, coalesce(v, false) AS variable, coalesce(i, false) AS internight, coalesce(r, false) AS recurrent, coalesce(known, false) AS known FROM n LEFT JOIN d ON d.obj_id = n.obj_id LEFT JOIN obj o ON o.obj_id = n.obj_id
WHERE coalesce(v, false) OR coalesce(i, false) OR coalesce(r, false) OR coalesce(known, false) OR (nights >= 3 AND epochs >= 20)""")
def _(t: Inputs) -> DataFrame:
    """Stars whose periods are looked for: those that any search or catalogue points to, and those with nights and epochs enough."""
    n = star_nights(t).groupBy("obj_id").agg(F.count("*").alias("nights"), F.sum("n_epochs").alias("epochs"))
    kinds = {"variable": "variable", "internight": "internight", "recurrent": "recurrent"}
    d = t.det.groupBy("obj_id").agg(*(F.bool_or(c("kind") == k).alias(name) for name, k in kinds.items()))
    out = n.join(d, "obj_id", "left").join(t.obj.select("obj_id", "known"), "obj_id", "left")
    out = out.withColumns({k: F.coalesce(k, F.lit(False)) for k in (*kinds, "known")})
    return out.filter("variable or internight or recurrent or known or (nights >= 3 and epochs >= 20)").select("obj_id", *kinds, "known")


@query("o8_strongest", """
WITH s AS (SELECT star_id, night_id, median(flux) AS f, median(fluxerr) / sqrt(count(*)) AS e FROM ep WHERE aper = 0 GROUP BY 1, 2), m AS (SELECT star_id, sum(f / e ** 2) / sum(1 / e ** 2) AS g, count(*) AS n FROM s GROUP BY 1)
SELECT star_id, round(sum(((f - g) / e) ** 2), 3) AS chi2 FROM s JOIN m USING (star_id) WHERE n >= 2 GROUP BY 1 ORDER BY sum(((f - g) / e) ** 2) DESC, star_id LIMIT 20""")
def _(t: Inputs) -> DataFrame:
    """The twenty stars that vary most between nights: a report for plots."""
    rows = QUERIES["a18_internight"](t.spark, t.folder)
    return rows.orderBy(F.desc("chi2"), "star_id").limit(20).select("star_id", "chi2")


def drop_frames(patterns: list[tuple[int, frozenset[int], int]], frames: list[int], least: int = 20, share: float = 0.3) -> tuple[list[int], bool]:
    """(dropped frames, whether every tile then has ``least`` stars that all kept frames show).

    ``patterns``: tile, the frames that stars of a pattern lack, how many such stars.  One frame goes at a time, for the tile that
    lacks most stars: the frame that most of its stars lack which lack only one, else that most of all its stars lack; ties
    go to the lower tile and frame.  A ``share`` of the frames may go.
    """
    dropped: set[int] = set()
    tiles = sorted({t for t, _, _ in patterns})
    while True:
        short = {t: least - sum(n for u, lacks, n in patterns if u == t and lacks <= dropped) for t in tiles}
        worst = min(tiles, key=lambda t: (-short[t], t), default=None)
        if worst is None or short[worst] <= 0:
            return sorted(dropped), worst is not None
        if len(dropped) >= int(share * len(frames)):
            return sorted(dropped), False
        rest = [(lacks - dropped, n) for u, lacks, n in patterns if u == worst]
        pool = [x for x in rest if len(x[0]) == 1] or rest
        count = {f: sum(n for lacks, n in pool if f in lacks) for f in frames if f not in dropped}
        dropped.add(min(count, key=lambda f: (-count[f], f)))


@query("g20_frame_selection")
def _(t: Inputs) -> DataFrame:
    """Frames of each night to leave out so that enough stars (three, on these small nights) are in all others.

    Stars come as the set of frames that they lack, counted: most lack none or the same, so a night of any number of stars
    is a few rows.
    """
    frames = t.table("frame").groupBy("night_id").agg(F.sort_array(F.collect_set("frame_index")).alias("frames"))
    good = t.ep.filter("aper = 0 and flags = 0").groupBy("night_id", "star_id").agg(F.collect_set("frame_index").alias("has"))
    lacks = good.join(frames, "night_id").select("night_id", "frames", F.sort_array(F.array_except("frames", "has")).alias("lacks"))
    patterns = lacks.groupBy("night_id", "frames", "lacks").agg(F.count("*").alias("n"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        frames = [int(f) for f in rows["frames"].iloc[0]]
        gone, enough = drop_frames([(0, frozenset(map(int, x)), int(n)) for x, n in zip(rows["lacks"], rows["n"])], frames, 3)
        return pd.DataFrame({"night_id": [rows["night_id"].iloc[0]], "dropped": [gone], "n_kept": [len(frames) - len(gone)], "enough": [enough]})

    return patterns.groupBy("night_id").applyInPandas(run, "night_id int, dropped array<int>, n_kept int, enough boolean")
