"""Further queries: eligibility, ties between nights, fits from moment sums, text and probability functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lightloom.functions import kernels as G
from lightloom.functions import scalar as X
from lightloom.operators import robust as R
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.statistics import _ENS, _Z, ensemble_terms, light_curves, r6, standardised
from lightloom.session import cut

c = F.col


@query("f7_f8_tails", f"""
WITH {_Z}, n AS (SELECT night_id, star_id, count(*) FILTER (WHERE z < -5) AS low, count(*) FILTER (WHERE z > 5) AS high FROM z GROUP BY 1, 2)
SELECT night_id, star_id, low, high FROM n WHERE low >= 3 AND low >= 3 * high""")
def _(t: Inputs) -> DataFrame:
    n = standardised(t).groupBy("night_id", "star_id").agg(F.count_if(c("z") < -5).alias("low"), F.count_if(c("z") > 5).alias("high"))
    return n.filter("low >= 3 and low >= 3 * high")


@query("j31_best_run", """
WITH n AS (SELECT obj_id, mn_run_id, count(*) AS n, max(loaded_at) AS l FROM det WHERE mn_run_id IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY n DESC, l DESC, mn_run_id DESC) AS r FROM n) SELECT obj_id, mn_run_id, n FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    n = t.det.filter("mn_run_id is not null").groupBy("obj_id", "mn_run_id").agg(F.count("*").alias("n"), F.max("loaded_at").alias("l"))
    best = n.groupBy("obj_id").agg(F.max(F.struct("n", "l", "mn_run_id")).alias("b"))
    return best.select("obj_id", "b.mn_run_id", "b.n")


@query("j24_shared_epochs", """
WITH e AS (SELECT det_id, night_id, tc_bjd_tdb AS t, duration_h / 48 AS h FROM det WHERE kind = 'transit' AND snr >= 5 AND tc_bjd_tdb IS NOT NULL AND duration_h > 0 AND night_id IS NOT NULL)
SELECT a.det_id, count(*) AS n FROM e a JOIN e b ON a.night_id = b.night_id AND a.det_id <> b.det_id AND abs(a.t - b.t) <= a.h GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    e = t.det.filter("kind = 'transit' and snr >= 5 and tc_bjd_tdb is not null and duration_h > 0 and night_id is not null")
    e = e.select("det_id", "night_id", c("tc_bjd_tdb").alias("t"), (c("duration_h") / 48).alias("h"))
    return R.counts_within(e, "night_id", "det_id", "t", "h").select("det_id", "n").filter("n > 0")


@query("a41_magnitude_histogram", "SELECT floor(mag * 2) / 2 AS bin, count(*) AS n FROM obj WHERE mag IS NOT NULL GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return t.obj.filter("mag is not null").groupBy((F.floor(c("mag") * 2) / 2).alias("bin")).agg(F.count("*").alias("n"))


@query("a43_pooled_chi2", f"WITH {_Z} SELECT night_id, round(median(z * z) / 0.45494, 5) AS pooled FROM z GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return standardised(t).groupBy("night_id").agg(r6(R.median(c("z") * c("z")) / 0.45494, "pooled", 5))


@query("g17_seeing_airmass", """
WITH x AS (SELECT e.star_id, -2.5 * log10(flux) AS y, fwhm AS a, airmass AS b FROM ep e JOIN fr f ON e.night_id = f.night_id AND e.frame_index = f.frame_index
  WHERE e.aper = 0 AND fwhm BETWEEN 0.5 AND 15 AND airmass BETWEEN 1 AND 3),
m AS (SELECT star_id, count(*) AS n, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM x GROUP BY 1)
SELECT star_id, n, round((bb * ay - ab * by_) / (aa * bb - ab * ab), 4) AS seeing, round((aa * by_ - ab * ay) / (aa * bb - ab * ab), 4) AS extinction FROM m WHERE n >= 20 AND aa * bb - ab * ab > 1e-6""")
def _(t: Inputs) -> DataFrame:
    """Each star's dependence on seeing and airmass from its moments: one shuffle of a few sums per star."""
    f = t.fr.filter("fwhm between 0.5 and 15 and airmass between 1 and 3").select("night_id", "frame_index", c("fwhm").alias("a"), c("airmass").alias("b"))
    x = t.ep.filter("aper = 0").join(f, ["night_id", "frame_index"]).withColumn("y", -2.5 * F.log10("flux"))
    m = x.groupBy("star_id").agg(
        F.count("*").alias("n"), F.var_pop("a").alias("aa"), F.var_pop("b").alias("bb"), F.covar_pop("a", "b").alias("ab"), F.covar_pop("a", "y").alias("ay"), F.covar_pop("b", "y").alias("by")
    )
    d = c("aa") * c("bb") - c("ab") * c("ab")
    m = m.filter((c("n") >= 20) & (d > 1e-6))
    return m.select("star_id", "n", r6((c("bb") * c("ay") - c("ab") * c("by")) / d, "seeing", 4), r6((c("aa") * c("by") - c("ab") * c("ay")) / d, "extinction", 4))


_TIE = """
s AS (SELECT star_id, night_id, -2.5 * log10(median(flux)) AS m, (1.0857 * 1.2533 * median(fluxerr / flux) / sqrt(count(*))) ** 2 + 0.003 ** 2 AS v FROM ep WHERE aper = 0 GROUP BY 1, 2),
k AS (SELECT * FROM s WHERE star_id IN (SELECT star_id FROM s GROUP BY 1 HAVING count(*) >= 2)), z0 AS (SELECT DISTINCT night_id, 0.0 AS z FROM k)"""


def _tied(rounds: int) -> str:
    sql = _TIE
    for i in range(rounds):
        sql += f""", m{i} AS (SELECT star_id, sum((m - z) / v) / sum(1 / v) AS mean FROM k JOIN z{i} USING (night_id) GROUP BY 1),
z{i + 1} AS (SELECT night_id, sum((m - mean) / v) / sum(1 / v) AS z FROM k JOIN m{i} USING (star_id) GROUP BY 1)"""
    return sql


def tie(t: Inputs, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """(star_id, night_id, med, m, v) of stars seen on several nights, and (night_id, z): zero points that tie their nights.

    Star means and night offsets in turn, from sums only; the means of the nights are taken from the epochs once for all rounds.
    """
    one = t.ep.filter("aper = 0")
    error = 1.0857 * 1.2533 * R.median(c("fluxerr") / c("flux")) / F.sqrt(F.count("*"))
    s = one.groupBy("star_id", "night_id").agg(R.median("flux").alias("med"), (error**2 + 0.003**2).alias("v")).withColumn("m", -2.5 * F.log10("med"))
    k = cut(s.withColumn("n", F.count("*").over(Window.partitionBy("star_id"))).filter("n >= 2").select("star_id", "night_id", "med", "m", "v"))
    z = k.select("night_id").distinct().withColumn("z", F.lit(0.0))
    for _ in range(rounds):
        mean = k.join(z, "night_id").groupBy("star_id").agg((F.sum((c("m") - c("z")) / c("v")) / F.sum(1 / c("v"))).alias("mean"))
        z = k.join(mean, "star_id").groupBy("night_id").agg((F.sum((c("m") - c("mean")) / c("v")) / F.sum(1 / c("v"))).alias("z"))
    return k, z


@query("g24_night_zero_points", f"WITH {_tied(3)} SELECT night_id, round(z, 5) AS zero_point FROM z3")
def _(t: Inputs) -> DataFrame:
    return tie(t)[1].select("night_id", r6(c("z"), "zero_point", 5))


@query("g27_g28_tied_means", f"WITH {_tied(3)} SELECT star_id, night_id, round(m - z, 5) AS mean, round(sqrt(v), 6) AS err FROM k JOIN z3 USING (night_id)")
def _(t: Inputs) -> DataFrame:
    """Nightly means of every star on the scale that ties the nights, with their errors over the floor."""
    k, z = tie(t)
    return k.join(z, "night_id").select("star_id", "night_id", r6(c("m") - c("z"), "mean", 5), r6(F.sqrt("v"), "err"))


@query("j13_on_common_axis", """
WITH n AS (SELECT target, night_id FROM night WHERE target IS NOT NULL), s AS (SELECT star_id, night_id, -2.5 * log10(median(flux)) AS m FROM ep WHERE aper = 0 GROUP BY 1, 2),
st AS (SELECT DISTINCT target, star_id FROM s JOIN n USING (night_id))
SELECT target, st.star_id, list(n.night_id ORDER BY n.night_id) AS nights, list(round(m, 5) ORDER BY n.night_id) AS mags FROM st JOIN n USING (target) LEFT JOIN s ON s.star_id = st.star_id AND s.night_id = n.night_id GROUP BY 1, 2""")
def _(t: Inputs) -> DataFrame:
    """Each star's magnitudes on the axis of all nights of its target, null where a night has no such star: a target's nights are one array."""
    axis = t.night.filter("target is not null").groupBy("target").agg(F.sort_array(F.collect_set("night_id")).alias("nights"))
    s = t.ep.filter("aper = 0").groupBy("star_id", "night_id").agg((-2.5 * F.log10(R.median("flux"))).alias("m"))
    own = s.join(t.night.select("night_id", "target").filter("target is not null"), "night_id")
    own = own.groupBy("target", "star_id").agg(F.map_from_entries(F.collect_list(F.struct("night_id", F.round("m", 5)))).alias("v"))
    return own.join(axis, "target").select("target", "star_id", "nights", F.transform("nights", lambda n: F.try_element_at("v", n)).alias("mags"))


@query("g21_frame_outliers")
def _(t: Inputs) -> DataFrame:
    """Frames whose common level is over three robust deviations from a quadratic in time; one row per frame of a night."""
    level = ensemble_terms(t).groupBy("night_id", "frame_index").agg((F.sum(c("w") * c("f")) / F.sum("w")).alias("r"))
    rows = level.join(t.fr.filter("bjd_tdb is not null").select("night_id", "frame_index", c("bjd_tdb").alias("t")), ["night_id", "frame_index"])

    def grouped(g: pd.DataFrame) -> pd.DataFrame:
        y, ok = np.log10(g["r"].to_numpy(float)), np.ones(len(g), bool)
        for _ in range(3):
            fit = G.weighted_fit(G.drifts(g["t"].to_numpy(float))[ok], y[ok], np.ones(ok.sum()))
            if fit is None:
                return g.iloc[:0][["night_id", "frame_index"]].assign(off=0.0)
            off = y - G.drifts(g["t"].to_numpy(float)) @ fit[0]
            s = 1.4826 * np.median(np.abs(off - np.median(off)))
            ok = np.abs(off) <= 3 * s if s > 0 else ok
        return g.assign(off=off)[["night_id", "frame_index", "off"]][~ok]

    return rows.groupBy("night_id").applyInPandas(grouped, "night_id int, frame_index int, off double")


@query("g16_normalised_series", """
SELECT star_id, count(*) AS n, round(sum(y), 4) AS total FROM (SELECT star_id, flux / median(flux) OVER (PARTITION BY night_id, star_id, aper) AS y FROM ep WHERE aper = 0) GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    level = t.ep.filter("aper = 0").groupBy("night_id", "star_id").agg(R.median("flux").alias("m"))
    x = t.ep.filter("aper = 0").join(level, ["night_id", "star_id"])
    return x.groupBy("star_id").agg(F.count("*").alias("n"), r6(F.sum(c("flux") / c("m")), "total", 4))


@query("o2_total_count", "SELECT status, count(*) AS n, count(*) FILTER (WHERE snr > 10) AS strong FROM det GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return t.det.groupBy("status").agg(F.count("*").alias("n"), F.count_if(c("snr") > 10).alias("strong"))


@query("o10_lowest_scores", f"""
WITH {_ENS}, s AS (SELECT night_id, star_id, stddev_pop(f) AS s FROM g GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY night_id ORDER BY round(s, 9), star_id) AS r FROM s)
SELECT night_id, star_id, r FROM r WHERE r <= 5""")
def _(t: Inputs) -> DataFrame:
    s = ensemble_terms(t).groupBy("night_id", "star_id").agg(F.stddev_pop("f").alias("s"))
    w = Window.partitionBy("night_id").orderBy(F.round("s", 9), "star_id")
    return s.select("night_id", "star_id", F.row_number().over(w).alias("r")).filter("r <= 5")


@query("x7_path_tokens", r"SELECT frame_id, regexp_extract(file_name, '^n(\d+)_', 1)::INT AS night, regexp_extract(file_name, '_(\d+)\.', 1)::INT AS number FROM frame WHERE regexp_matches(file_name, '^n\d+_\d+\.')")
def _(t: Inputs) -> DataFrame:
    f = t.table("frame").filter(c("file_name").rlike(r"^n\d+_\d+\."))
    part = lambda p: F.regexp_extract("file_name", p, 1).cast("int")
    return f.select("frame_id", part(r"^n(\d+)_").alias("night"), part(r"_(\d+)\.").alias("number"))


@query("x14_infer_catalogue", """
SELECT obj_id, CASE WHEN starts_with(trim(gaia_id), 'Gaia DR3 ') THEN 'Gaia DR3' WHEN nullif(trim(gaia_id), '') IS NOT NULL THEN 'Gaia' END AS catalogue FROM sky_object""")
def _(t: Inputs) -> DataFrame:
    g = F.trim("gaia_id")
    return t.table("sky_object").select("obj_id", F.when(g.startswith("Gaia DR3 "), "Gaia DR3").when(g != "", "Gaia").alias("catalogue"))


@query("x2_chord_angle", "SELECT obj_id, round(degrees(2 * asin(least(1, sqrt((cos(radians(dec)) * cos(radians(ra)) - 1) ** 2 + (cos(radians(dec)) * sin(radians(ra))) ** 2 + sin(radians(dec)) ** 2) / 2))), 7) AS angle FROM pos")
def _(t: Inputs) -> DataFrame:
    from lightloom.operators.sky import separation_arcsec

    return t.pos.select("obj_id", r6(separation_arcsec(c("ra"), c("dec"), F.lit(0.0), F.lit(0.0)) / 3600, "angle", 7))


@query("x24_chi2_probability", """
SELECT shape_id, round(exp(-(depth * 100) / 2), 8) AS p FROM shape WHERE depth > 0""")
def _(t: Inputs) -> DataFrame:
    return t.shape.filter("depth > 0").select("shape_id", r6(X.chi2_sf(c("depth") * 100, F.lit(2)), "p", 8))


@query("x28_interpolation", """
SELECT obj_id, round(CASE WHEN mag <= 10 THEN 0.01 WHEN mag >= 18 THEN 0.2 WHEN mag < 14 THEN 0.01 + (mag - 10) / 4 * 0.02 ELSE 0.03 + (mag - 14) / 4 * 0.17 END, 7) AS noise FROM obj WHERE mag IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    grid = lambda *v: F.array(*map(F.lit, v))
    return t.obj.filter("mag is not null").select("obj_id", r6(R.interpolate(c("mag"), grid(10.0, 14.0, 18.0), grid(0.01, 0.03, 0.2)), "noise", 7))


@query("x23_polynomial_terms", """
SELECT obj_id, round((ra - 180) ** 2, 5) AS "xi^2", round((ra - 180) * dec, 5) AS "xi*eta", round(dec ** 2, 5) AS "eta^2" FROM pos""")
def _(t: Inputs) -> DataFrame:
    xi, eta = c("ra") - 180, c("dec")
    return t.pos.select("obj_id", r6(xi**2, "xi^2", 5), r6(xi * eta, "xi*eta", 5), r6(eta**2, "eta^2", 5))


@query("j28_light_curves", f"""
WITH {_ENS}, m AS (SELECT night_id, frame_index, sum(w * f) / sum(w) AS r FROM g GROUP BY 1, 2) SELECT g.night_id, g.frame_index, star_id, round(f / r, 6) AS lc FROM g JOIN m USING (night_id, frame_index)""")
def _(t: Inputs) -> DataFrame:
    return light_curves(t).select("night_id", "frame_index", "star_id", r6(c("lc"), "lc"))


@query("t6_changed_nights", """
SELECT DISTINCT d.obj_id FROM det d WHERE night_id IN (SELECT night_id FROM (SELECT night_id, max(loaded_at) AS l FROM matched_epoch GROUP BY 1) e JOIN night n USING (night_id) WHERE e.l > n.loaded_at + INTERVAL 1 DAY)""")
def _(t: Inputs) -> DataFrame:
    """Objects to judge again because rows of one of their nights came late."""
    last = t.table("matched_epoch").groupBy("night_id").agg(F.max("loaded_at").alias("l"))
    late = last.join(t.night.select("night_id", "loaded_at"), "night_id").filter("l > loaded_at + INTERVAL 1 DAY").select("night_id")
    return t.det.join(late, "night_id", "left_semi").select("obj_id").distinct()


_SEP = """degrees(2 * asin(least(1, sqrt((cos(radians(o.dec)) * cos(radians(o.ra)) - cos(radians(p.dec)) * cos(radians(p.ra))) ** 2
    + (cos(radians(o.dec)) * sin(radians(o.ra)) - cos(radians(p.dec)) * sin(radians(p.ra))) ** 2 + (sin(radians(o.dec)) - sin(radians(p.dec))) ** 2) / 2))) * 3600"""


@query("j9_k_nearest", f"""
WITH n AS (SELECT o.obj_id, p.obj_id AS other, {_SEP} AS sep FROM pos o JOIN pos p ON p.obj_id <> o.obj_id),
r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY sep, other) AS r FROM n) SELECT obj_id, other, r AS rank FROM r WHERE r <= 25""")
def _(t: Inputs) -> DataFrame:
    from lightloom.operators.sky import k_nearest

    return k_nearest(t.pos.select("obj_id", "ra", "dec"), 25, "obj_id").select("obj_id", "other", "rank")


_FLOOR = """
st AS (SELECT night_id, star_id, median(flux) AS med FROM ep WHERE aper = 0 GROUP BY 1, 2),
x AS (SELECT e.night_id, star_id, flux / med AS x FROM ep e JOIN st USING (night_id, star_id) WHERE aper = 0), xm AS (SELECT night_id, star_id, median(x) AS mx FROM x GROUP BY 1, 2),
rm AS (SELECT night_id, star_id, 1.4826 * median(abs(x - mx)) AS rms FROM x JOIN xm USING (night_id, star_id) GROUP BY 1, 2),
bn AS (SELECT night_id, star_id, rms, round(-2.5 * log10(med) / 2) AS bin FROM rm JOIN st USING (night_id, star_id) WHERE rms > 0),
fl AS (SELECT night_id, bin, median(rms) AS floor FROM bn GROUP BY 1, 2)"""


@query("g22_comparison_round", f"WITH {_FLOOR} SELECT night_id, star_id, round(rms / floor, 5) AS score FROM bn JOIN fl USING (night_id, bin) WHERE rms <= 2 * floor")
def _(t: Inputs) -> DataFrame:
    """One round of the choice of comparison stars: those not noisier than twice the floor of their brightness."""
    one = t.ep.filter("aper = 0")
    level = one.groupBy("night_id", "star_id").agg(R.median("flux").alias("med"))
    x = one.join(level, ["night_id", "star_id"]).withColumn("x", c("flux") / c("med"))
    rms = R.with_mad(x, ["night_id", "star_id"], "x", "rms").filter(c("rms") < float("inf")).select("night_id", "star_id", "rms")
    b = rms.join(level, ["night_id", "star_id"]).withColumn("bin", F.round(-2.5 * F.log10("med") / 2))
    floor = b.groupBy("night_id", "bin").agg(R.median("rms").alias("floor"))
    return b.join(floor, ["night_id", "bin"]).filter("rms <= 2 * floor").select("night_id", "star_id", r6(c("rms") / c("floor"), "score", 5))


@query("j11_match_nights")
def _(t: Inputs) -> DataFrame:
    """Stars of all nights of every target, tied into one list per target by place (each night sees its own objects).

    ``global`` counts within a target; a night without a target is a set of its own.
    """
    from lightloom.operators.growing import match_sets

    target = F.coalesce("target", F.concat(F.lit("night "), "night_id"))
    nights = t.night.filter("removed_at is null").select(target.alias("set"), "night_id", c("night_id").alias("step"))
    seen = t.ep.select("night_id", c("star_id").alias("star")).distinct().join(nights, "night_id")
    tied = match_sets(seen.join(t.pos.select(c("obj_id").alias("star"), "ra", "dec"), "star"))
    return tied.select(c("set").alias("target"), "night_id", "star", "global")


@query("g25_noise_floors", """
WITH s AS (SELECT star_id, night_id, -2.5 * log10(median(flux)) AS m, (1.0857 * 1.2533 * median(fluxerr / flux) / sqrt(count(*))) ** 2 AS v FROM ep WHERE aper = 0 GROUP BY 1, 2),
p AS (SELECT floor(m / 2)::BIGINT AS bin, m - lag(m) OVER w AS d, v + lag(v) OVER w AS s2 FROM s WINDOW w AS (PARTITION BY star_id ORDER BY night_id))
SELECT bin, count(*) AS n, round(quantile_cont(greatest(d * d / 0.45494 - s2, 0), 0.5), 8) AS extra FROM p WHERE d IS NOT NULL GROUP BY 1 HAVING count(*) >= 5""")
def _(t: Inputs) -> DataFrame:
    """Extra variance of each brightness bin that makes the nights of its stars agree: median(d^2 / (s^2 + V)) = 0.45494."""
    one = t.ep.filter("aper = 0")
    error = 1.0857 * 1.2533 * R.median(c("fluxerr") / c("flux")) / F.sqrt(F.count("*"))
    s = one.groupBy("star_id", "night_id").agg((-2.5 * F.log10(R.median("flux"))).alias("m"), (error**2).alias("v"))
    w = Window.partitionBy("star_id").orderBy("night_id")
    pairs = s.withColumns({"d": c("m") - F.lag("m").over(w), "s2": c("v") + F.lag("v").over(w), "bin": F.floor(c("m") / 2)}).filter("d is not null")
    # The residual of 60 bisections is that of one exact percentile over candidates: V of each pair alone, taken at the median.
    alone = F.greatest(c("d") ** 2 / 0.45494 - c("s2"), F.lit(0.0))
    return R.exact_quantiles(pairs.withColumn("alone", alone), ["bin"], "alone", [0.5]).filter("n >= 5").select("bin", "n", r6(c("q")[0], "extra", 8))


@query("g29_period_compatibility", """
WITH e AS (SELECT obj_id, det_id, tc_bjd_tdb AS t FROM det WHERE kind = 'transit' AND tc_bjd_tdb IS NOT NULL),
o AS (SELECT obj_id, period FROM obj WHERE period > 0), f AS (SELECT obj_id, min(t) AS t0 FROM e GROUP BY 1)
SELECT e.obj_id, det_id, round(abs(((e.t - t0) / period + 0.5) % 1 - 0.5) * period, 5) AS off_days FROM e JOIN o USING (obj_id) JOIN f USING (obj_id)""")
def _(t: Inputs) -> DataFrame:
    """How far each event is from the ephemeris of its object's period through the first event."""
    e = t.det.filter("kind = 'transit' and tc_bjd_tdb is not null").select("obj_id", "det_id", c("tc_bjd_tdb").alias("t"))
    first = e.groupBy("obj_id").agg(F.min("t").alias("t0"))
    p = e.join(t.obj.filter("period > 0").select("obj_id", "period"), "obj_id").join(first, "obj_id")
    off = F.abs(X.phase(c("t"), c("t0"), c("period"), centred=True)) * c("period")
    return p.select("obj_id", "det_id", r6(off, "off_days", 5))


def tiles_of(counts: dict[tuple[int, int], int], least: int) -> dict[tuple[int, int], int]:
    """Cells of a grid joined until every tile has ``least`` stars: the poorest tile goes to its poorest neighbour, and
    tiles stay rectangles (what overlaps is absorbed).  ``counts`` has one entry per cell, not per star."""
    boxes = [[x, y, x, y] for x, y in sorted(counts)]

    def stars(b: list[int]) -> int:
        return sum(n for (x, y), n in counts.items() if b[0] <= x <= b[2] and b[1] <= y <= b[3])

    while len(boxes) > 1:
        sizes = [stars(b) for b in boxes]
        k = min(range(len(boxes)), key=lambda i: (sizes[i], i))
        if sizes[k] >= least:
            break
        a = boxes[k]
        gap = lambda b: max(b[0] - a[2], a[0] - b[2], 0) + max(b[1] - a[3], a[1] - b[3], 0)
        m = min((i for i in range(len(boxes)) if i != k), key=lambda i: (gap(boxes[i]), sizes[i], i))
        joined = [min(a[0], boxes[m][0]), min(a[1], boxes[m][1]), max(a[2], boxes[m][2]), max(a[3], boxes[m][3])]
        rest = [b for i, b in enumerate(boxes) if i not in (k, m)]
        while hit := [b for b in rest if b[0] <= joined[2] and b[2] >= joined[0] and b[1] <= joined[3] and b[3] >= joined[1]]:
            for b in hit:
                joined = [min(b[0], joined[0]), min(b[1], joined[1]), max(b[2], joined[2]), max(b[3], joined[3])]
            rest = [b for b in rest if b not in hit]
        boxes = sorted([*rest, joined])
    return {cell: i for cell in counts for i, b in enumerate(boxes) if b[0] <= cell[0] <= b[2] and b[1] <= cell[1] <= b[3]}


@query("g23_adaptive_tiles")
def _(t: Inputs) -> DataFrame:
    """Tiles of the sky of at least 50 objects, from 648 cells of ten degrees at most; objects meet their tile by cell."""
    cell = t.pos.select("obj_id", F.floor(c("ra") / 10).cast("int").alias("x"), F.floor(F.least(c("dec") + 90, F.lit(179.999)) / 10).cast("int").alias("y"))
    counts = {(r["x"], r["y"]): r["n"] for r in cell.groupBy("x", "y").agg(F.count("*").alias("n")).collect()}
    tile = t.spark.createDataFrame([(x, y, k) for (x, y), k in tiles_of(counts, 50).items()], "x int, y int, tile int")
    return cell.join(F.broadcast(tile), ["x", "y"]).groupBy("tile").agg(F.count("*").alias("n"), F.countDistinct("x", "y").alias("cells"))
