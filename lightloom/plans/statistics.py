"""Queries of filters, aggregates and window-like functions over the photometry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lightloom.functions import scalar as X
from lightloom.operators import robust as R
from lightloom.operators import sky
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401

c = F.col
STAR = ["night_id", "star_id", "aper"]


def r6(x: Column, name: str, digits: int = 6) -> Column:
    """Rounded, so that the order of a sum does not show."""
    return F.round(x.cast("double"), digits).alias(name)


@query("f1_finite_position", "SELECT obj_id, round(ra, 9) AS ra, round(dec, 9) AS dec FROM pos")
def _(t: Inputs) -> DataFrame:
    return t.pos.select("obj_id", r6(c("ra"), "ra", 9), r6(c("dec"), "dec", 9))


@query("f2_presence_cut", """
WITH n AS (SELECT night_id, count(*) AS frames FROM frame GROUP BY 1),
s AS (SELECT night_id, star_id, count(DISTINCT frame_index) AS seen FROM ep GROUP BY 1, 2)
SELECT night_id, star_id, seen, round(seen / frames, 6) AS presence FROM s JOIN n USING (night_id) WHERE seen / frames >= 0.8""")
def _(t: Inputs) -> DataFrame:
    frames = t.table("frame").groupBy("night_id").agg(F.count("*").alias("frames"))
    seen = t.ep.groupBy("night_id", "star_id").agg(F.countDistinct("frame_index").alias("seen"))
    share = c("seen") / c("frames")
    return seen.join(frames, "night_id").filter(share >= 0.8).select("night_id", "star_id", "seen", r6(share, "presence"))


def usable(t: Inputs) -> DataFrame:
    """Epochs of kept frames whose flags have none of the bits 252; -1 (absent) is not tested for bits."""
    kept = t.fr.filter("kept").select("night_id", "frame_index", "bjd_tdb", "airmass")
    return t.ep.filter((c("flags") >= 0) & (c("flags").bitwiseAND(252) == 0)).join(kept, ["night_id", "frame_index"])


@query("f3_epoch_ok", """
SELECT e.night_id, star_id, aper, count(*) AS n_ok, round(sum(flux), 3) AS flux FROM ep e JOIN fr f ON e.night_id = f.night_id AND e.frame_index = f.frame_index
WHERE f.kept AND flags >= 0 AND (flags & 252) = 0 GROUP BY 1, 2, 3""")
def _(t: Inputs) -> DataFrame:
    return usable(t).groupBy(*STAR).agg(F.count("*").alias("n_ok"), r6(F.sum("flux"), "flux", 3))


def _pool(t: Inputs, snr: float, clean_flags: bool) -> DataFrame:
    star = t.ep.filter("aper = 0").groupBy("night_id", "star_id").agg(
        F.bool_and(c("flags") == 0).alias("unflagged"), F.median("snr").alias("snr"), F.count("*").alias("n")
    )
    star = star.filter((c("snr") >= snr) & (c("unflagged") if clean_flags else F.lit(True)))
    alone = sky.isolated(t.pos.select("obj_id", "ra", "dec"), 5.0, "obj_id").select(c("obj_id").alias("star_id"))
    return star.join(alone, "star_id", "left_semi") if clean_flags else star


_ALONE = """alone AS (SELECT obj_id FROM pos o WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.obj_id <> o.obj_id
  AND p.dec BETWEEN o.dec - 0.0014 AND o.dec + 0.0014
  AND degrees(2 * asin(least(1, sqrt((cos(radians(o.dec)) * cos(radians(o.ra)) - cos(radians(p.dec)) * cos(radians(p.ra))) ** 2
    + (cos(radians(o.dec)) * sin(radians(o.ra)) - cos(radians(p.dec)) * sin(radians(p.ra))) ** 2
    + (sin(radians(o.dec)) - sin(radians(p.dec))) ** 2) / 2))) * 3600 <= 5))"""


@query("f4_reference_candidates", f"""
WITH s AS (SELECT night_id, star_id, bool_and(flags = 0) AS ok, median(snr) AS snr, count(*) AS n FROM ep WHERE aper = 0 GROUP BY 1, 2), {_ALONE}
SELECT night_id, star_id, n, round(snr, 3) AS snr FROM s WHERE ok AND snr >= 15 AND star_id IN (SELECT obj_id FROM alone)""")
def _(t: Inputs) -> DataFrame:
    return _pool(t, 15, True).select("night_id", "star_id", "n", r6(c("snr"), "snr", 3))


@query("f5_comparison_pool", """
SELECT night_id, star_id, n, round(snr, 3) AS snr FROM (SELECT night_id, star_id, median(snr) AS snr, count(*) AS n FROM ep WHERE aper = 0 GROUP BY 1, 2) WHERE snr >= 5""")
def _(t: Inputs) -> DataFrame:
    return _pool(t, 5, False).select("night_id", "star_id", "n", r6(c("snr"), "snr", 3))


@query("f10_effective_min_epochs", "SELECT night_id, greatest(20, ceil(0.5 * n_kept), 1)::BIGINT AS min_epochs FROM night")
def _(t: Inputs) -> DataFrame:
    return t.night.select("night_id", F.greatest(F.lit(20), F.ceil(0.5 * c("n_kept")), F.lit(1)).cast("long").alias("min_epochs"))


@query("f11_dirty_objects", """
SELECT o.obj_id FROM sky_object o LEFT JOIN (SELECT obj_id, min(computed_at) AS m FROM transit_shape GROUP BY 1) s USING (obj_id)
WHERE m IS NULL OR o.updated_at > m""")
def _(t: Inputs) -> DataFrame:
    first = t.table("transit_shape").groupBy("obj_id").agg(F.min("computed_at").alias("m"))
    return t.table("sky_object").join(first, "obj_id", "left").filter("m is null or updated_at > m").select("obj_id")


@query("f13_f14_distinct_and_lists", """
SELECT det_id FROM det WHERE status IS DISTINCT FROM 'REJECTED' AND kind IN ('transit', 'bls') AND flags NOT IN ('EDGE', 'PARTIAL')""")
def _(t: Inputs) -> DataFrame:
    keep = ~c("status").eqNullSafe("REJECTED") & c("kind").isin("transit", "bls") & ~c("flags").isin("EDGE", "PARTIAL")
    return t.det.filter(keep).select("det_id")


@query("f15_substring", "SELECT obj_id FROM sky_object WHERE name ILIKE '%j22%' OR known_name ILIKE '%nvl%'")
def _(t: Inputs) -> DataFrame:
    return t.table("sky_object").filter(c("name").ilike("%j22%") | c("known_name").ilike("%nvl%")).select("obj_id")


@query("f16_flag_tokens", r"""
SELECT det_id, regexp_matches(flags, '(^|[|])(EDGE|PARTIAL)([|]|$)') AS incomplete FROM det WHERE flags IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    return t.det.filter("flags is not null").select("det_id", X.has_token(c("flags"), "EDGE", "PARTIAL").alias("incomplete"))


@query("f18_disqualifying_type", """
SELECT cat_id, coalesce(len(list_filter(string_split(upper(var_type), '|'), lambda x: contains(x, 'EA') OR contains(x, 'EW'))) > 0, false) AS out FROM catalog_source""")
def _(t: Inputs) -> DataFrame:
    return t.table("catalog_source").select("cat_id", X.any_keyword(c("var_type"), ("EA", "EW")).alias("out"))


@query("a1_a2_median_mad", """
WITH m AS (SELECT night_id, median(fwhm) AS m FROM fr WHERE fwhm IS NOT NULL GROUP BY 1),
d AS (SELECT night_id, any_value(m) AS m, 1.4826 * median(abs(fwhm - m)) AS s, count(*) AS n FROM fr JOIN m USING (night_id) WHERE fwhm IS NOT NULL GROUP BY 1)
SELECT night_id, round(m, 6) AS median, round(CASE WHEN s = 0 THEN 'inf'::DOUBLE ELSE s END, 6) AS sigma, n FROM d""")
def _(t: Inputs) -> DataFrame:
    return R.with_mad(t.fr.filter("fwhm is not null"), ["night_id"], "fwhm").select("night_id", r6(c("median"), "median"), r6(c("sigma"), "sigma"), "n")


def _clipped_sql(rounds: int) -> str:
    sql = "r0 AS (SELECT night_id, star_id, flux AS x, 1 / fluxerr ** 2 AS w FROM ep WHERE aper = 0)"
    for k in range(rounds):
        sql += f""", m{k} AS (SELECT night_id, star_id, sum(w * x) / sum(w) AS m FROM r{k} GROUP BY 1, 2),
e{k} AS (SELECT r.*, x - m AS res FROM r{k} r JOIN m{k} USING (night_id, star_id)),
c{k} AS (SELECT night_id, star_id, median(res) AS c FROM e{k} GROUP BY 1, 2),
s{k} AS (SELECT night_id, star_id, any_value(c) AS c, 1.4826 * median(abs(res - c)) AS s FROM e{k} JOIN c{k} USING (night_id, star_id) GROUP BY 1, 2),
r{k + 1} AS (SELECT night_id, star_id, x, w FROM e{k} JOIN s{k} USING (night_id, star_id) WHERE s = 0 OR abs(res - c) <= 3 * s)"""
    return f"WITH {sql} SELECT night_id, star_id, round(sum(w * x) / sum(w), 4) AS mean, round(1 / sqrt(sum(w)), 6) AS error, count(*) AS n FROM r{rounds} GROUP BY 1, 2"


@query("a3_weighted_clipped_combine", _clipped_sql(2))
def _(t: Inputs) -> DataFrame:
    out = R.clipped_mean(t.ep.filter("aper = 0").select("night_id", "star_id", "flux", "fluxerr"), ["night_id", "star_id"], "flux", "fluxerr", rounds=2)
    return out.select("night_id", "star_id", r6(c("mean"), "mean", 4), r6(c("error"), "error"), "n")


@query("a4_quantile_bins", """
WITH e AS (SELECT list_distinct(quantile_cont(mag, [0, 0.25, 0.5, 0.75, 1])) AS edge FROM obj WHERE mag IS NOT NULL),
x AS (SELECT obj_id, mag, least(len(list_filter(list_sort(edge), lambda v: v <= mag)), len(edge) - 1) - 1 AS bin FROM obj, e WHERE mag IS NOT NULL)
SELECT bin, count(*) AS n, round(min(mag), 4) AS least, round(max(mag), 4) AS most FROM x GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    rows = t.obj.filter("mag is not null")
    found = R.exact_quantiles(rows, [], "mag", [q / 4 for q in range(5)]).select(F.array_distinct("q")).first()  # five numbers
    edges = found[0] if found else [0.0, 0.0]
    binned = rows.select("mag", R.bin_of(c("mag"), F.array(*map(F.lit, edges))).cast("long").alias("bin"))
    return binned.groupBy("bin").agg(F.count("*").alias("n"), r6(F.min("mag"), "least", 4), r6(F.max("mag"), "most", 4))


_STATS = """
st AS (SELECT night_id, star_id, aper, median(flux) AS med FROM ep GROUP BY 1, 2, 3),
x AS (SELECT e.*, flux / med AS x, fluxerr / med AS s FROM ep e JOIN st USING (night_id, star_id, aper)),
xm AS (SELECT night_id, star_id, aper, median(x) AS mx FROM x GROUP BY 1, 2, 3),
stats AS (SELECT night_id, star_id, aper, 1.4826 * median(abs(x - mx)) AS rms, sum(((x - 1) / s) ** 2) / greatest(count(*) - 1, 1) AS chi2,
  median(s) AS expected, count(*) AS n FROM x JOIN xm USING (night_id, star_id, aper) GROUP BY 1, 2, 3)"""


def star_stats(t: Inputs) -> DataFrame:
    """Scatter, reduced chi-squared about 1, expected noise and number of each star's normalised epochs."""
    x = normalised(t)
    spread = R.with_mad(x, STAR, "x", "rms").select(*STAR, F.when(c("rms") < float("inf"), c("rms")).otherwise(0.0).alias("rms"))
    rest = x.groupBy(*STAR).agg(
        (F.sum(((c("x") - 1) / c("s")) ** 2) / F.greatest(F.count("*") - 1, F.lit(1))).alias("chi2"), R.median("s").alias("expected"), F.count("*").alias("n")
    )
    return spread.join(rest, STAR)


def normalised(t: Inputs) -> DataFrame:
    """Epochs with flux and error relative to the star's median of the night."""
    level = t.ep.groupBy(*STAR).agg(R.median("flux").alias("med"))
    return t.ep.join(level, STAR).withColumns({"x": c("flux") / c("med"), "s": c("fluxerr") / c("med")})


@query("a11_star_stats", f"WITH {_STATS} SELECT night_id, star_id, aper, round(rms, 6) AS rms, round(chi2, 4) AS chi2, round(expected, 6) AS expected, n FROM stats")
def _(t: Inputs) -> DataFrame:
    return star_stats(t).select(*STAR, r6(c("rms"), "rms"), r6(c("chi2"), "chi2", 4), r6(c("expected"), "expected"), "n")


@query("f9_noise_cut", f"""
WITH {_STATS}, cand AS (SELECT DISTINCT night_id, obj_id AS star_id FROM det WHERE kind = 'transit' AND night_id IS NOT NULL)
SELECT s.night_id, s.star_id FROM stats s JOIN night g ON g.night_id = s.night_id LEFT JOIN cand ON cand.night_id = s.night_id AND cand.star_id = s.star_id
WHERE s.aper = 0 AND ((s.n >= greatest(20, ceil(0.5 * n_kept)) AND s.expected <= 0.05) OR cand.star_id IS NOT NULL)""")
def _(t: Inputs) -> DataFrame:
    chosen = t.det.filter("kind = 'transit' and night_id is not null").select("night_id", c("obj_id").alias("star_id"), F.lit(True).alias("cand")).distinct()
    least = t.night.select("night_id", F.greatest(F.lit(20), F.ceil(0.5 * c("n_kept"))).alias("least"))
    stats = star_stats(t).filter("aper = 0").join(least, "night_id").join(chosen, ["night_id", "star_id"], "left")
    return stats.filter("(n >= least and expected <= 0.05) or coalesce(cand, false)").select("night_id", "star_id")


@query("a12_a13_best_aperture", f"WITH {_STATS} SELECT night_id, star_id, arg_min(aper, rms + aper * 1e-12) AS best, round(min(rms), 6) AS rms FROM stats GROUP BY 1, 2")
def _(t: Inputs) -> DataFrame:
    best = star_stats(t).groupBy("night_id", "star_id").agg(F.min(F.struct("rms", "aper")).alias("b"))
    return best.select("night_id", "star_id", c("b.aper").alias("best"), r6(c("b.rms"), "rms"))


_P2P = """
d AS (SELECT night_id, star_id, aper, flux - lag(flux) OVER w AS d, frame_index - lag(frame_index) OVER w AS step FROM ep
      WINDOW w AS (PARTITION BY night_id, star_id, aper ORDER BY frame_index)),
dm AS (SELECT night_id, star_id, aper, median(d) AS m, count(*) AS pairs FROM d WHERE step = 1 GROUP BY 1, 2, 3),
p2p AS (SELECT night_id, star_id, aper, 1.4826 * median(abs(d - m)) / sqrt(2) AS p2p, any_value(pairs) AS pairs FROM d JOIN dm USING (night_id, star_id, aper)
        WHERE step = 1 GROUP BY 1, 2, 3)"""


def point_to_point(t: Inputs) -> DataFrame:
    w = Window.partitionBy(*STAR).orderBy("frame_index")
    d = t.ep.withColumns({"d": c("flux") - F.lag("flux").over(w), "step": c("frame_index") - F.lag("frame_index").over(w)}).filter("step = 1")
    return R.with_mad(d, STAR, "d").filter("n >= 10").select(*STAR, F.when(c("sigma") < float("inf"), c("sigma") / math.sqrt(2)).otherwise(0.0).alias("p2p"), c("n").alias("pairs"))


@query("a14_n2_point_to_point", f"WITH {_P2P} SELECT night_id, star_id, aper, round(p2p, 4) AS p2p, pairs FROM p2p WHERE pairs >= 10")
def _(t: Inputs) -> DataFrame:
    return point_to_point(t).select(*STAR, r6(c("p2p"), "p2p", 4), "pairs")


@query("a15_error_inflation", f"""
WITH {_P2P}, e AS (SELECT night_id, star_id, aper, median(fluxerr) AS e, avg(CASE WHEN flags >= 0 AND (flags & 3) <> 0 THEN 1.0 ELSE 0 END) AS blend FROM ep GROUP BY 1, 2, 3)
SELECT night_id, star_id, aper, round(greatest(1, p2p / e), 6) AS scale, blend >= 0.05 AS blended FROM p2p JOIN e USING (night_id, star_id, aper) WHERE pairs >= 10""")
def _(t: Inputs) -> DataFrame:
    blend = F.avg(((c("flags") >= 0) & (c("flags").bitwiseAND(3) != 0)).cast("double"))
    e = t.ep.groupBy(*STAR).agg(R.median("fluxerr").alias("e"), blend.alias("blend"))
    return point_to_point(t).join(e, STAR).select(*STAR, r6(F.greatest(F.lit(1.0), c("p2p") / c("e")), "scale"), (c("blend") >= 0.05).alias("blended"))


_ENS = """
st AS (SELECT night_id, star_id, median(flux) AS base, median(fluxerr ** 2) AS v FROM ep WHERE aper = 0 GROUP BY 1, 2),
g AS (SELECT e.night_id, e.frame_index, e.star_id, flux / base AS f, base ** 2 / v AS w FROM ep e JOIN st USING (night_id, star_id) WHERE e.aper = 0)"""


def ensemble_terms(t: Inputs) -> DataFrame:
    """Each star's flux relative to its own level, with the weight of its level over its median variance."""
    one = t.ep.filter("aper = 0")
    level = one.groupBy("night_id", "star_id").agg(R.median("flux").alias("base"), R.median(c("fluxerr") ** 2).alias("v"))
    return one.join(level, ["night_id", "star_id"]).select("night_id", "frame_index", "star_id", (c("flux") / c("base")).alias("f"), (c("base") ** 2 / c("v")).alias("w"))


@query("a8_reference_flux", f"""
WITH {_ENS} SELECT night_id, frame_index, round(sum(w * f) / sum(w), 6) AS r, round(1 / sqrt(sum(w)), 6) AS sigma, count(*) AS n_used FROM g GROUP BY 1, 2""")
def _(t: Inputs) -> DataFrame:
    g = ensemble_terms(t).groupBy("night_id", "frame_index")
    return g.agg(r6(F.sum(c("w") * c("f")) / F.sum("w"), "r"), r6(1 / F.sqrt(F.sum("w")), "sigma"), F.count("*").alias("n_used"))


@query("a9_reference_median", f"""
WITH {_ENS}, m AS (SELECT night_id, frame_index, median(f) AS m FROM g GROUP BY 1, 2)
SELECT night_id, frame_index, round(any_value(m), 6) AS r, round(1.4826 * median(abs(f - m)) / sqrt(count(*)), 6) AS sigma FROM g JOIN m USING (night_id, frame_index)
GROUP BY 1, 2 HAVING count(*) > 2""")
def _(t: Inputs) -> DataFrame:
    m = R.with_mad(ensemble_terms(t), ["night_id", "frame_index"], "f").filter("n > 2")
    s = F.when(c("sigma") < float("inf"), c("sigma")).otherwise(0.0)
    return m.select("night_id", "frame_index", r6(c("median"), "r"), r6(s / F.sqrt(c("n")), "sigma"))


@query("a10_n9_leave_one_out", f"""
WITH {_ENS}, a AS (SELECT night_id, frame_index, sum(w * f) AS swf, sum(w) AS sw, count(*) AS n FROM g GROUP BY 1, 2)
SELECT night_id, frame_index, star_id, round((swf - w * f) / (sw - w), 6) AS others FROM g JOIN a USING (night_id, frame_index) WHERE n > 1""")
def _(t: Inputs) -> DataFrame:
    out = R.leave_one_out(ensemble_terms(t), ["night_id", "frame_index"], "f", "w").filter("others is not null")
    return out.select("night_id", "frame_index", "star_id", r6(c("others"), "others"))


_Z = f"""{_ENS}, lc AS (SELECT g.night_id, g.frame_index, star_id, f / r AS lc FROM g JOIN (SELECT night_id, frame_index, sum(w * f) / sum(w) AS r FROM g GROUP BY 1, 2) USING (night_id, frame_index)),
lm AS (SELECT night_id, star_id, median(lc) AS m FROM lc GROUP BY 1, 2),
ls AS (SELECT night_id, star_id, any_value(m) AS m, 1.4826 * median(abs(lc - m)) AS s FROM lc JOIN lm USING (night_id, star_id) GROUP BY 1, 2),
z AS (SELECT night_id, frame_index, star_id, lc, (lc - m) / s AS z FROM lc JOIN ls USING (night_id, star_id) WHERE s > 0)"""


def light_curves(t: Inputs) -> DataFrame:
    """Relative light curves: each star's term over the frame's weighted mean."""
    g = ensemble_terms(t)
    mean = g.groupBy("night_id", "frame_index").agg((F.sum(c("w") * c("f")) / F.sum("w")).alias("r"))
    return g.join(mean, ["night_id", "frame_index"]).select("night_id", "frame_index", "star_id", (c("f") / c("r")).alias("lc"))


def standardised(t: Inputs) -> DataFrame:
    lc = light_curves(t)
    s = R.with_mad(lc, ["night_id", "star_id"], "lc").filter(c("sigma") < float("inf"))
    return lc.join(s, ["night_id", "star_id"]).select("night_id", "frame_index", "star_id", "lc", ((c("lc") - c("median")) / c("sigma")).alias("z"))


@query("a17_systematic_frames", f"WITH {_Z} SELECT night_id, frame_index, round(avg(CASE WHEN abs(z) > 3 THEN 1.0 ELSE 0 END), 6) AS share FROM z GROUP BY 1, 2 HAVING share > 0.3")
def _(t: Inputs) -> DataFrame:
    share = F.avg((F.abs("z") > 3).cast("double"))
    return standardised(t).groupBy("night_id", "frame_index").agg(share.alias("share")).filter("share > 0.3").select("night_id", "frame_index", r6(c("share"), "share"))


@query("a16_frame_error_scale", f"""
WITH {_Z}, zm AS (SELECT night_id, frame_index, median(z) AS m FROM z GROUP BY 1, 2),
s AS (SELECT night_id, frame_index, median(abs(z - m)) AS s FROM z JOIN zm USING (night_id, frame_index) GROUP BY 1, 2),
n AS (SELECT night_id, median(s) AS typical FROM s GROUP BY 1)
SELECT night_id, frame_index, round(least(10, greatest(0.5, s / typical)), 5) AS scale FROM s JOIN n USING (night_id) WHERE typical > 0""")
def _(t: Inputs) -> DataFrame:
    s = R.with_mad(standardised(t), ["night_id", "frame_index"], "z", "s")
    s = s.select("night_id", "frame_index", F.when(c("s") < float("inf"), c("s")).otherwise(0.0).alias("s"))
    typical = s.groupBy("night_id").agg(R.median("s").alias("typical")).filter("typical > 0")
    return s.join(typical, "night_id").select("night_id", "frame_index", r6(F.least(F.lit(10.0), F.greatest(F.lit(0.5), c("s") / c("typical"))), "scale", 5))


_VN = f"""{_ENS}, lc AS (SELECT g.night_id, g.frame_index, star_id, f / r AS lc FROM g JOIN (SELECT night_id, frame_index, sum(w * f) / sum(w) AS r FROM g GROUP BY 1, 2) USING (night_id, frame_index)),
q AS (SELECT *, lc - lag(lc) OVER (PARTITION BY night_id, star_id ORDER BY frame_index) AS d FROM lc)"""


@query("a37_a38_a39_variability", f"""
WITH {_VN}, v AS (SELECT night_id, star_id, count(*) AS n, sum(d * d) / nullif(var_pop(lc) * count(*), 0) AS eta, stddev_pop(lc) AS s,
  quantile_cont(lc, 0.98) - quantile_cont(lc, 0.02) AS amp FROM q GROUP BY 1, 2)
SELECT night_id, star_id, n, round(eta, 4) AS eta, round((2 - eta) / sqrt(4 / (n + 1)), 4) AS significance, round(s, 6) AS rms_std, round(amp, 6) AS amplitude FROM v WHERE n >= 10""")
def _(t: Inputs) -> DataFrame:
    w = Window.partitionBy("night_id", "star_id").orderBy("frame_index")
    q = light_curves(t).withColumn("d", c("lc") - F.lag("lc").over(w))
    span = F.percentile("lc", F.lit(0.98)) - F.percentile("lc", F.lit(0.02))
    v = q.groupBy("night_id", "star_id").agg(
        F.count("*").alias("n"), F.try_divide(F.sum(c("d") * c("d")), F.var_pop("lc") * F.count("*")).alias("eta"), F.stddev_pop("lc").alias("s"), span.alias("amp")
    ).filter("n >= 10")
    return v.select(
        "night_id", "star_id", "n", r6(c("eta"), "eta", 4), r6((2 - c("eta")) / F.sqrt(4 / (c("n") + 1)), "significance", 4), r6(c("s"), "rms_std"), r6(c("amp"), "amplitude")
    )


_NIGHTS = """
s AS (SELECT star_id, night_id, median(flux) AS f, median(fluxerr) / sqrt(count(*)) AS e FROM ep WHERE aper = 0 GROUP BY 1, 2),
m AS (SELECT star_id, sum(f / e ** 2) / sum(1 / e ** 2) AS g, count(*) AS n FROM s GROUP BY 1)"""


@query("a18_internight", f"""
WITH {_NIGHTS} SELECT star_id, any_value(n) AS n_nights, round(sum(((f - g) / e) ** 2), 3) AS chi2, any_value(n) - 1 AS dof, round((max(f) - min(f)) / any_value(g), 6) AS amplitude
FROM s JOIN m USING (star_id) WHERE n >= 2 GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    s = t.ep.filter("aper = 0").groupBy("star_id", "night_id").agg(R.median("flux").alias("f"), (R.median("fluxerr") / F.sqrt(F.count("*"))).alias("e"))
    m = s.groupBy("star_id").agg((F.sum(c("f") / c("e") ** 2) / F.sum(1 / c("e") ** 2)).alias("g"), F.count("*").alias("n")).filter("n >= 2")
    return s.join(m, "star_id").groupBy("star_id").agg(
        F.first("n").alias("n_nights"), r6(F.sum(((c("f") - c("g")) / c("e")) ** 2), "chi2", 3), (F.first("n") - 1).alias("dof"),
        r6((F.max("f") - F.min("f")) / F.first("g"), "amplitude"),
    )


@query("a35_n13_phase_coverage", """
WITH p AS (SELECT e.star_id, period, f.bjd_tdb AS t, (((f.bjd_tdb - 2454100) / period) % 1 + 1) % 1 AS ph
  FROM ep e JOIN fr f ON e.night_id = f.night_id AND e.frame_index = f.frame_index JOIN obj o ON o.obj_id = e.star_id WHERE e.aper = 0 AND period > 0 AND f.bjd_tdb IS NOT NULL)
SELECT star_id, round(count(DISTINCT least(floor(ph * 20), 19)) / 20, 6) AS coverage, round((max(t) - min(t)) / any_value(period), 4) AS n_cycles FROM p GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    at = t.ep.filter("aper = 0").join(t.fr.filter("bjd_tdb is not null").select("night_id", "frame_index", "bjd_tdb"), ["night_id", "frame_index"])
    p = at.join(t.obj.filter("period > 0").select(c("obj_id").alias("star_id"), "period"), "star_id")
    ph = X.phase(c("bjd_tdb"), F.lit(2454100.0), c("period"))
    return p.groupBy("star_id").agg(
        r6(F.countDistinct(F.least(F.floor(ph * 20), F.lit(19))) / 20, "coverage"), r6((F.max("bjd_tdb") - F.min("bjd_tdb")) / F.first("period"), "n_cycles", 4)
    )


@query("a42_bright_decile", """
WITH r AS (SELECT obj_id, mag, row_number() OVER (ORDER BY mag, obj_id) AS k, count(*) OVER () AS n FROM obj WHERE mag IS NOT NULL) SELECT obj_id, round(mag, 4) AS mag FROM r WHERE k <= ceil(0.1 * n)""")
def _(t: Inputs) -> DataFrame:
    """The brightest tenth, ties by id: the bound is an exact percentile, and only rows at the bound are put in order."""
    rows = t.obj.filter("mag is not null").select("obj_id", "mag")
    n = rows.agg(F.count("*").alias("n")).select(F.ceil(0.1 * c("n")).alias("k"), F.when(c("n") > 1, (F.ceil(0.1 * c("n")) - 1) / (c("n") - 1)).otherwise(0.0).alias("q"))
    k, q = n.first() or (0, 0.0)
    if not k:
        return rows
    bound = R.exact_quantiles(rows, [], "mag", [float(q)]).first()["q"][0]
    side = rows.withColumn("off", F.round(c("mag") - bound, 9))
    below = side.filter("off < 0")
    left = int(k) - below.count()
    at = side.filter("off = 0").orderBy("obj_id").limit(max(left, 0))
    return below.unionByName(at).select("obj_id", r6(c("mag"), "mag", 4))


_GAPS = "d AS (SELECT night_id, bjd_tdb AS t, bjd_tdb - lag(bjd_tdb) OVER (PARTITION BY night_id ORDER BY bjd_tdb) AS d FROM fr WHERE bjd_tdb IS NOT NULL)"


def cadence(t: Inputs) -> DataFrame:
    """First and last frame time and median spacing of each night."""
    w = Window.partitionBy("night_id").orderBy("bjd_tdb")
    d = t.fr.filter("bjd_tdb is not null").withColumn("d", c("bjd_tdb") - F.lag("bjd_tdb").over(w))
    return d.groupBy("night_id").agg(F.min("bjd_tdb").alias("t_first"), F.max("bjd_tdb").alias("t_last"), R.median("d").alias("cadence"))


@query("a44_night_cadence", f"WITH {_GAPS} SELECT night_id, round(min(t), 6) AS t_first, round(max(t), 6) AS t_last, round(median(d), 8) AS cadence FROM d GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return cadence(t).select("night_id", r6(c("t_first"), "t_first"), r6(c("t_last"), "t_last"), r6(c("cadence"), "cadence", 8))


@query("n12_gaps", f"WITH {_GAPS}, m AS (SELECT night_id, median(d) AS m FROM d GROUP BY 1) SELECT night_id, round(t - d, 6) AS gap_from, round(t, 6) AS gap_to FROM d JOIN m USING (night_id) WHERE d > 2 * m")
def _(t: Inputs) -> DataFrame:
    w = Window.partitionBy("night_id").orderBy("bjd_tdb")
    d = t.fr.filter("bjd_tdb is not null").withColumn("before", F.lag("bjd_tdb").over(w))
    return d.join(cadence(t), "night_id").filter("bjd_tdb - before > 2 * cadence").select("night_id", r6(c("before"), "gap_from"), r6(c("bjd_tdb"), "gap_to"))


@query("n3_n8_running_sums", """
SELECT night_id, frame_index, sum(n_sources) OVER w AS so_far, max(n_sources) OVER w AS most FROM frame WINDOW w AS (PARTITION BY night_id ORDER BY frame_index ROWS UNBOUNDED PRECEDING)""")
def _(t: Inputs) -> DataFrame:
    w = Window.partitionBy("night_id").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, 0)
    return t.table("frame").select("night_id", "frame_index", F.sum("n_sources").over(w).alias("so_far"), F.max("n_sources").over(w).alias("most"))


@query("n4_running_median", """
SELECT night_id, frame_index, round(CASE WHEN count(fwhm) OVER w >= 4 THEN quantile_cont(fwhm, 0.5) OVER w END, 6) AS level FROM fr
WINDOW w AS (PARTITION BY night_id ORDER BY frame_index ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def _(t: Inputs) -> DataFrame:
    return t.fr.select("night_id", "frame_index", r6(R.running_median("fwhm", ["night_id"], "frame_index", 3), "level"))


@query("n10_local_maxima", """
SELECT night_id, frame_index FROM (SELECT night_id, frame_index, fwhm, lag(fwhm) OVER w AS a, lead(fwhm) OVER w AS b FROM fr WHERE fwhm IS NOT NULL
WINDOW w AS (PARTITION BY night_id ORDER BY frame_index)) WHERE fwhm > a AND fwhm >= b""")
def _(t: Inputs) -> DataFrame:
    w = Window.partitionBy("night_id").orderBy("frame_index")
    x = t.fr.filter("fwhm is not null").withColumns({"a": F.lag("fwhm").over(w), "b": F.lead("fwhm").over(w)})
    return x.filter("fwhm > a and fwhm >= b").select("night_id", "frame_index")


@query("n11_runs_of_kept_frames", """
WITH r AS (SELECT night_id, frame_index, kept, row_number() OVER (PARTITION BY night_id ORDER BY frame_index) AS r FROM frame),
g AS (SELECT *, r - row_number() OVER (PARTITION BY night_id ORDER BY frame_index) AS g FROM r WHERE kept)
SELECT night_id, min(frame_index) AS "first", max(frame_index) AS "last", count(*) AS n FROM g GROUP BY night_id, g""")
def _(t: Inputs) -> DataFrame:
    return R.islands(t.table("frame"), ["night_id"], "frame_index", c("kept"))


@query("a5_noise_floor", f"""
WITH {_STATS}, b AS (SELECT round(-2.5 * log10(med)) AS bin, rms FROM stats JOIN st USING (night_id, star_id, aper) WHERE rms > 0)
SELECT bin, count(*) AS n, round(median(log10(rms)), 6) AS floor FROM b GROUP BY 1 HAVING count(*) >= 5""")
def _(t: Inputs) -> DataFrame:
    level = t.ep.groupBy(*STAR).agg(R.median("flux").alias("med"))
    b = star_stats(t).filter("rms > 0").join(level, STAR).select(F.round(-2.5 * F.log10("med")).alias("bin"), "rms")
    return R.exact_quantiles(b.withColumn("y", F.log10("rms")), ["bin"], "y", [0.5]).filter("n >= 5").select("bin", "n", r6(c("q")[0], "floor"))
