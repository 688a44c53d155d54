"""Queries of joins, ordering, sets, scalar functions and changes of the store."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lightloom.functions import scalar as X
from lightloom.operators import robust as R
from lightloom.operators import sky, store
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.statistics import cadence, r6

c = F.col

_SEP = """degrees(2 * asin(least(1, sqrt((cos(radians({a}.dec)) * cos(radians({a}.ra)) - cos(radians({b}.dec)) * cos(radians({b}.ra))) ** 2
    + (cos(radians({a}.dec)) * sin(radians({a}.ra)) - cos(radians({b}.dec)) * sin(radians({b}.ra))) ** 2
    + (sin(radians({a}.dec)) - sin(radians({b}.dec))) ** 2) / 2))) * 3600"""
_PART = r"regexp_extract_all({0}, '[0-9]+(?:\.[0-9]*)?')"
_DEGREES = "coalesce(try_cast({0} AS DOUBLE), (CASE WHEN ltrim({0}) LIKE '-%' THEN -1 ELSE 1 END) * CASE len(" + _PART + ") WHEN 1 THEN " + _PART + "[1]::DOUBLE" \
    " WHEN 3 THEN {1} * (" + _PART + "[1]::DOUBLE + " + _PART + "[2]::DOUBLE / 60 + " + _PART + "[3]::DOUBLE / 3600) END)"
_CAT = f"""cat AS (SELECT * FROM (SELECT cat_id, {_DEGREES.format('ra_text', 15)} AS ra, {_DEGREES.format('dec_text', 1)} AS dec FROM catalog_source) WHERE ra IS NOT NULL AND dec IS NOT NULL)"""
_PAIRS = f"""{_CAT}, pairs AS (SELECT cat_id, obj_id, {_SEP.format(a='k', b='o')} AS sep FROM cat k JOIN pos o ON o.dec BETWEEN k.dec - 0.0014 AND k.dec + 0.0014
  WHERE {_SEP.format(a='k', b='o')} <= 5)"""


def places(t: Inputs) -> DataFrame:
    """Catalogue rows that have a place, in degrees: decimal text as it is, sexagesimal right ascensions are hours."""

    def degrees(text: str, unit: int) -> Column:
        three = F.regexp_count(text, F.lit(r"[0-9]+(?:\.[0-9]*)?")) == 3
        return F.coalesce(c(text).try_cast("double"), X.sexagesimal(c(text)) * F.when(three, unit).otherwise(1))

    rows = t.table("catalog_source").select("cat_id", degrees("ra_text", 15).alias("ra"), degrees("dec_text", 1).alias("dec"))
    return rows.dropna(subset=["ra", "dec"])


@query("j1_sky_nearest", f"""
WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY cat_id ORDER BY sep, obj_id) AS r FROM pairs) SELECT cat_id, obj_id, round(sep, 4) AS sep FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    near = sky.nearest(sky.sky_join(places(t), t.pos, 5.0, "cat_id", "obj_id"))
    return near.select(c("l_id").alias("cat_id"), c("r_id").alias("obj_id"), r6(c("sep_arcsec"), "sep", 4))


@query("j2_j10_closest_wins", f"""
WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY cat_id ORDER BY sep, obj_id) AS r FROM pairs),
w AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY sep, cat_id) AS k FROM r WHERE r = 1) SELECT cat_id, obj_id FROM w WHERE k = 1""")
def _(t: Inputs) -> DataFrame:
    won = sky.closest_wins(sky.sky_join(places(t), t.pos, 5.0, "cat_id", "obj_id"))
    return won.select(c("l_id").alias("cat_id"), c("r_id").alias("obj_id"))


@query("j4_isolated", f"""SELECT obj_id FROM pos o WHERE NOT EXISTS (SELECT 1 FROM pos p WHERE p.obj_id <> o.obj_id
  AND p.dec BETWEEN o.dec - 0.0028 AND o.dec + 0.0028 AND {_SEP.format(a='o', b='p')} <= 10)""")
def _(t: Inputs) -> DataFrame:
    return sky.isolated(t.pos.select("obj_id", "ra", "dec"), 10.0, "obj_id").select("obj_id")


@query("j5_nearest_other", f"""
WITH n AS (SELECT o.obj_id, p.obj_id AS other, {_SEP.format(a='o', b='p')} AS sep FROM pos o JOIN pos p ON p.obj_id <> o.obj_id),
r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY sep, other) AS r FROM n)
SELECT obj_id, other, round(log10(greatest(sep, 0.05)), 6) AS crowding FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    near = sky.k_nearest(t.pos.select("obj_id", "ra", "dec"), 1, "obj_id")
    return near.select("obj_id", "other", r6(F.log10(F.greatest("sep_arcsec", F.lit(0.05))), "crowding"))


@query("j6_radius_all", f"""
WITH {_PAIRS} SELECT obj_id, count(*) AS n, list(cat_id ORDER BY cat_id) AS cats FROM pairs GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    pairs = sky.sky_join(places(t), t.pos, 5.0, "cat_id", "obj_id")
    return pairs.groupBy(c("r_id").alias("obj_id")).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("l_id")).alias("cats"))


@query("j8_x21_dilution", f"""
WITH n AS (SELECT o.obj_id, p.mag AS pm, o.mag AS om, {_SEP.format(a='o', b='p')} AS sep, p.obj_id AS other FROM pos o JOIN pos p ON p.obj_id <> o.obj_id
  AND p.dec BETWEEN o.dec - 0.006 AND o.dec + 0.006 WHERE {_SEP.format(a='o', b='p')} <= 20),
r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY sep, other) AS r FROM n)
SELECT obj_id, round(10 ** (-0.4 * (pm - om)) / (1 + 10 ** (-0.4 * (pm - om))), 6) AS dilution FROM r WHERE r = 1 AND pm IS NOT NULL AND om IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    near = sky.nearest(sky.sky_join(t.pos, t.pos, 20.0, "obj_id", "obj_id").filter("l_id <> r_id"))
    mags = t.obj.filter("mag is not null").select("obj_id", "mag")
    own, other = mags.select(c("obj_id").alias("l_id"), c("mag").alias("om")), mags.select(c("obj_id").alias("r_id"), c("mag").alias("pm"))
    ratio = X.flux_of(c("pm") - c("om"))
    return near.join(own, "l_id").join(other, "r_id").select(c("l_id").alias("obj_id"), r6(ratio / (1 + ratio), "dilution"))


@query("j14_cone", f"""
WITH k AS (SELECT 331.58 AS ra, 60.75 AS dec) SELECT obj_id FROM pos o, k WHERE {_SEP.format(a='o', b='k')} <= 0.5 * 3600""")
def _(t: Inputs) -> DataFrame:
    return sky.cone(t.pos, 331.58, 60.75, 0.5).select("obj_id")


@query("x3_gnomonic", """
WITH m AS (SELECT floor(ra / 15) AS tx, floor(dec / 15) AS ty, obj_id, radians(dec) AS d, radians(ra - (floor(ra / 15) * 15 + 7.5)) AS a, radians(greatest(-85, least(85, floor(dec / 15) * 15 + 7.5))) AS d0 FROM pos)
SELECT obj_id, round(degrees(cos(d) * sin(a) / (sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a))), 6) AS xi,
  round(degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / (sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a))), 6) AS eta FROM m""")
def _(t: Inputs) -> DataFrame:
    """Every object in the tangent plane of its field's centre (fields of 15 degrees)."""
    ra0, dec0 = F.floor(c("ra") / 15) * 15 + 7.5, F.greatest(F.lit(-85.0), F.least(F.lit(85.0), F.floor(c("dec") / 15) * 15 + 7.5))
    xi, eta = sky.gnomonic(c("ra"), c("dec"), ra0, dec0)
    return t.pos.select("obj_id", r6(xi, "xi"), r6(eta, "eta"))


@query("a21_a22_star_nights", """
SELECT star_id, count(DISTINCT e.night_id) AS n_nights, min(night_date) AS first_night, max(night_date) AS last_night FROM ep e JOIN night n ON n.night_id = e.night_id GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    # One row per star and night before the join: the dimension is met by the fewest rows.
    pairs = t.ep.select("star_id", "night_id").distinct().join(t.night.select("night_id", "night_date"), "night_id")
    return pairs.groupBy("star_id").agg(F.count("*").alias("n_nights"), F.min("night_date").alias("first_night"), F.max("night_date").alias("last_night"))


@query("a23_a27_detection_counts", """
SELECT obj_id, count(*) AS n_detections, round(max(CASE WHEN kind = 'transit' THEN depth END), 6) AS depth, count(*) FILTER (WHERE coalesce(status, 'UNCONFIRMED') = 'UNCONFIRMED') AS n_open,
  coalesce(bool_or(kind IN ('transit', 'bls')), false) AS exop_ev FROM det GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    return t.det.groupBy("obj_id").agg(
        F.count("*").alias("n_detections"), r6(F.max(F.when(c("kind") == "transit", c("depth"))), "depth"),
        F.count_if(F.coalesce("status", F.lit("UNCONFIRMED")) == "UNCONFIRMED").alias("n_open"),
        F.coalesce(F.bool_or(c("kind").isin("transit", "bls")), F.lit(False)).alias("exop_ev"),
    )


@query("a24_ordered_set_median", "SELECT kind, round(quantile_cont(snr, 0.5), 4) AS snr FROM det WHERE snr IS NOT NULL GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    """Few kinds hold all rows, so no buffer may hold a kind's."""
    return R.exact_quantiles(t.det, ["kind"], "snr", [0.5]).select("kind", r6(c("q")[0], "snr", 4))


@query("a25_string_agg", "SELECT obj_id, string_agg(DISTINCT kind, ', ' ORDER BY kind) AS kinds FROM det GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    return t.det.groupBy("obj_id").agg(F.array_join(F.sort_array(F.collect_set("kind")), ", ").alias("kinds"))


@query("a28_a31_arrays", """
WITH a AS (SELECT obj_id, list(DISTINCT night_id ORDER BY night_id) AS nights FROM det WHERE night_id IS NOT NULL GROUP BY 1)
SELECT obj_id, nights, list_min(nights) AS least, list_max(nights) AS most FROM a""")
def _(t: Inputs) -> DataFrame:
    a = t.det.filter("night_id is not null").groupBy("obj_id").agg(F.sort_array(F.collect_set("night_id")).alias("nights"))
    return a.select("obj_id", "nights", F.array_min("nights").alias("least"), F.array_max("nights").alias("most"))


@query("a19_a29_recurrent", "SELECT obj_id, count(DISTINCT night_id) AS n FROM det WHERE kind = 'variable' GROUP BY 1 HAVING count(DISTINCT night_id) >= 2")
def _(t: Inputs) -> DataFrame:
    return t.det.filter("kind = 'variable'").groupBy("obj_id").agg(F.countDistinct("night_id").alias("n")).filter("n >= 2")


@query("a30_common_value", """
SELECT target, CASE WHEN count(DISTINCT filter_band) = 1 THEN min(filter_band) WHEN count(DISTINCT filter_band) > 1 THEN 'mixed' END AS band,
  CASE WHEN min(zp) = max(zp) THEN round(min(zp)::DOUBLE, 4) END AS zp FROM night GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    n, z = F.countDistinct("filter_band"), c("zp").cast("double")
    return t.night.groupBy("target").agg(
        F.when(n == 1, F.min("filter_band")).when(n > 1, F.lit("mixed")).alias("band"), r6(F.when(F.min(z) == F.max(z), F.min(z)), "zp", 4)
    )


@query("a32_mode", """
WITH n AS (SELECT night_id, fit AS v, count(*) AS n, min(frame_index) AS f FROM (SELECT night_id, frame_index, exptime::VARCHAR AS fit FROM frame WHERE exptime IS NOT NULL) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY night_id ORDER BY n DESC, f) AS r FROM n) SELECT night_id, round(v::DOUBLE, 3) AS exptime FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    n = t.table("frame").filter("exptime is not null").groupBy("night_id", "exptime").agg(F.count("*").alias("n"), F.min("frame_index").alias("f"))
    best = n.groupBy("night_id").agg(F.max_by("exptime", F.struct("n", -c("f"))).alias("exptime"))
    return best.select("night_id", r6(c("exptime"), "exptime", 3))


@query("a33_zero_point", """
WITH m AS (SELECT telescope, median(zp::DOUBLE) AS zp, count(*) AS n FROM night WHERE zp_source <> 'assumed' GROUP BY 1)
SELECT night_id, round(CASE WHEN zp_source = 'assumed' THEN coalesce(CASE WHEN n >= 2 THEN m.zp END, 20) ELSE night.zp END, 4) AS zp FROM night LEFT JOIN m USING (telescope)""")
def _(t: Inputs) -> DataFrame:
    m = t.night.filter("zp_source <> 'assumed'").groupBy("telescope").agg(R.median(c("zp").cast("double")).alias("typical"), F.count("*").alias("n"))
    zp = F.when(c("zp_source") == "assumed", F.coalesce(F.when(c("n") >= 2, c("typical")), F.lit(20.0))).otherwise(c("zp").cast("double"))
    return t.night.join(m, "telescope", "left").select("night_id", r6(zp, "zp", 4))


@query("a34_counts_with_zero", """
SELECT s.status, count(det_id) AS n FROM (VALUES ('CONFIRMED'), ('REJECTED'), ('UNCONFIRMED'), ('PENDING')) s(status) LEFT JOIN det ON det.status = s.status GROUP BY 1""")
def _(t: Inputs) -> DataFrame:
    wanted = t.spark.createDataFrame([("CONFIRMED",), ("REJECTED",), ("UNCONFIRMED",), ("PENDING",)], "status string")
    n = t.det.groupBy("status").agg(F.count("*").alias("n"))
    return wanted.join(n, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


@query("a36_event_histogram", """
WITH f AS (SELECT night_id, frame_index, bjd_tdb AS t0, lead(bjd_tdb) OVER (PARTITION BY night_id ORDER BY bjd_tdb) AS t1 FROM fr WHERE bjd_tdb IS NOT NULL)
SELECT f.night_id, frame_index, count(*) AS n FROM f JOIN det d ON d.night_id = f.night_id AND tc_bjd_tdb >= t0 AND tc_bjd_tdb < t1 GROUP BY 1, 2""")
def _(t: Inputs) -> DataFrame:
    # Frame and event times in one order: each event belongs to the last frame before it, no pair is formed.
    frames = t.fr.filter("bjd_tdb is not null").select("night_id", c("bjd_tdb").alias("t"), "frame_index")
    events = t.det.filter("tc_bjd_tdb is not null and night_id is not null").select("night_id", c("tc_bjd_tdb").alias("t"), F.lit(None).cast("int").alias("frame_index"))
    w = Window.partitionBy("night_id").orderBy("t", F.col("frame_index").isNull())
    line = frames.unionByName(events).withColumns(
        {"at": F.last("frame_index", ignorenulls=True).over(w), "last": F.max(F.when(c("frame_index").isNotNull(), c("t"))).over(Window.partitionBy("night_id"))}
    )
    inside = line.filter("frame_index is null and at is not null and t < last")
    return inside.groupBy("night_id", c("at").alias("frame_index")).agg(F.count("*").alias("n"))


@query("n1_argmax", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY snr DESC, det_id) AS r FROM det WHERE kind = 'transit' AND snr IS NOT NULL)
SELECT obj_id, det_id, round(snr, 4) AS snr FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    # A struct's maximum combines before the shuffle, which a window cannot.
    best = t.det.filter("kind = 'transit' and snr is not null").groupBy("obj_id").agg(F.max(F.struct("snr", -c("det_id"))).alias("b"))
    return best.select("obj_id", (-c("b")["col2"]).alias("det_id"), r6(c("b.snr"), "snr", 4))


@query("n7_requests_ahead", """
SELECT det_id, row_number() OVER (PARTITION BY kind ORDER BY loaded_at, det_id) - 1 AS ahead FROM det WHERE status = 'UNCONFIRMED'""")
def _(t: Inputs) -> DataFrame:
    w = Window.partitionBy("kind").orderBy("loaded_at", "det_id")
    return t.det.filter("status = 'UNCONFIRMED'").select("det_id", (F.row_number().over(w) - 1).alias("ahead"))


@query("j15_j16_object_summary", """
WITH d AS (SELECT obj_id, count(*) AS n_det FROM det GROUP BY 1), s AS (SELECT obj_id, count(*) AS n_shape FROM shape GROUP BY 1),
r AS (SELECT obj_id, count(DISTINCT review_id) AS n_rev FROM detection_review_orphan GROUP BY 1)
SELECT o.obj_id, coalesce(n_det, 0) AS n_det, coalesce(n_shape, 0) AS n_shape, coalesce(n_rev, 0) AS n_rev, coalesce(n_det, n_shape, n_rev) IS NOT NULL AS any_row
FROM obj o LEFT JOIN d USING (obj_id) LEFT JOIN s USING (obj_id) LEFT JOIN r USING (obj_id)""")
def _(t: Inputs) -> DataFrame:
    parts = {"n_det": t.det, "n_shape": t.shape, "n_rev": t.table("detection_review_orphan").dropDuplicates(["review_id"])}
    out = t.obj.select("obj_id")
    for name, rows in parts.items():
        out = out.join(rows.groupBy("obj_id").agg(F.count("*").alias(name)), "obj_id", "left")
    return out.select("obj_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in parts), F.coalesce(*parts).isNotNull().alias("any_row"))


@query("j17_full_outer", """
WITH a AS (SELECT obj_id, night_id, count(*) AS n_det FROM det WHERE night_id IS NOT NULL GROUP BY 1, 2),
b AS (SELECT obj_id, night_id, count(DISTINCT review_id) AS n_rev FROM detection_review_orphan WHERE night_id IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(a.obj_id, b.obj_id) AS obj_id, coalesce(a.night_id, b.night_id) AS night_id, n_det, n_rev FROM a FULL JOIN b ON a.obj_id = b.obj_id AND a.night_id = b.night_id""")
def _(t: Inputs) -> DataFrame:
    a = t.det.filter("night_id is not null").groupBy("obj_id", "night_id").agg(F.count("*").alias("n_det"))
    b = t.table("detection_review_orphan").filter("night_id is not null").groupBy("obj_id", "night_id").agg(F.countDistinct("review_id").alias("n_rev"))
    return a.join(b, ["obj_id", "night_id"], "full")


@query("j18_j19_semi_anti", """
SELECT obj_id FROM obj WHERE obj_id IN (SELECT obj_id FROM det WHERE kind = 'transit') AND NOT EXISTS (SELECT 1 FROM shape s WHERE s.obj_id = obj.obj_id)""")
def _(t: Inputs) -> DataFrame:
    return t.obj.join(t.det.filter("kind = 'transit'"), "obj_id", "left_semi").join(t.shape, "obj_id", "left_anti").select("obj_id")


@query("j20_exists_or", "SELECT obj_id FROM obj o WHERE known OR EXISTS (SELECT 1 FROM det d WHERE d.obj_id = o.obj_id AND d.snr > 20)")
def _(t: Inputs) -> DataFrame:
    strong = t.det.filter("snr > 20").select("obj_id").distinct().withColumn("strong", F.lit(True))
    return t.obj.join(strong, "obj_id", "left").filter("known or strong").select("obj_id")


@query("j21_latest_row", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY computed_at DESC, shape_id DESC) AS r FROM shape) SELECT o.obj_id, shape_id FROM obj o LEFT JOIN r ON r.obj_id = o.obj_id AND r = 1""")
def _(t: Inputs) -> DataFrame:
    last = t.shape.groupBy("obj_id").agg(F.max(F.struct("computed_at", "shape_id")).alias("l")).select("obj_id", "l.shape_id")
    return t.obj.select("obj_id").join(last, "obj_id", "left")


@query("j22_correlated_scalar", """
SELECT obj_id, (SELECT count(*) FROM det d WHERE d.obj_id = o.obj_id AND kind = 'transit') AS n_transit, (SELECT round(max(snr), 4) FROM det d WHERE d.obj_id = o.obj_id) AS best FROM obj o""")
def _(t: Inputs) -> DataFrame:
    a = t.det.groupBy("obj_id").agg(F.count_if(c("kind") == "transit").alias("n_transit"), r6(F.max("snr"), "best", 4))
    return t.obj.select("obj_id").join(a, "obj_id", "left").select("obj_id", F.coalesce("n_transit", F.lit(0)).alias("n_transit"), "best")


_EVENTS = """
ev AS (SELECT det_id, night_id, tc_bjd_tdb AS tc, duration_h / 24 AS w, abs(depth) AS d, duration_h / 24 / snr AS e, coalesce(regexp_matches(flags, '(^|[|])(EDGE|PARTIAL)([|]|$)'), false) AS low
  FROM det WHERE night_id IS NOT NULL AND tc_bjd_tdb IS NOT NULL AND duration_h > 0 AND abs(depth) > 0 AND snr > 0)"""
#: Classes of ln duration that are told apart: factors of 1.5 from a minute to a month.
_CLASSES = 12


def events(t: Inputs) -> DataFrame:
    """Timed events of nights: duration in days, depth, error of the time (duration over signal to noise), whether the duration is only a minimum."""
    usable = "night_id is not null and tc_bjd_tdb is not null and duration_h > 0 and abs(depth) > 0 and snr > 0"
    w = c("duration_h") / 24
    return t.det.filter(usable).select(
        "det_id", "night_id", c("tc_bjd_tdb").alias("tc"), w.alias("w"), F.abs("depth").alias("d"), (w / c("snr")).alias("e"), X.has_token(c("flags"), "EDGE", "PARTIAL").alias("low")
    )


def lookalikes(t: Inputs) -> DataFrame:
    """Pairs of events of one night alike in duration and depth, with their time window and its share of the night.

    A minimum duration is like every longer one.  Events fall into classes of ln duration and ln depth no finer than the
    similarity, so a pair is only formed in the same or a neighbouring class of depth and a class of duration that can be alike:
    the join has three equality keys, whatever a night's share of all events.
    """
    kind = F.greatest(F.lit(-_CLASSES), F.least(F.lit(_CLASSES), F.floor(F.log(c("w") * 24) / F.log(F.lit(1.5))))).cast("int")
    e = events(t).withColumns({"kw": kind, "kd": F.floor(F.log("d") / F.log(F.lit(2.0)))})
    one = [c("det_id").alias("i"), c("tc").alias("ti"), c("w").alias("wi"), c("d").alias("di"), c("e").alias("ei"), c("low").alias("li")]
    # Classes at hand take any partner, longer ones too if the own duration is a minimum, shorter ones only such minima.
    looks = F.transform(F.sequence(F.lit(-_CLASSES), F.lit(_CLASSES)), lambda k: F.struct(k.alias("kw"), ((F.abs(k - c("kw")) <= 1) | (c("low") & (k > c("kw")))).alias("any")))
    looks = F.filter(looks, lambda x: x["any"] | (x["kw"] <= c("kw") + 1))
    a = e.select("night_id", *one, F.explode(looks).alias("l"), "kd").select("night_id", "i", "ti", "wi", "di", "ei", "li", "l.kw", "l.any", F.explode(F.array(*(c("kd") + s for s in (-1, 0, 1)))).alias("kd"))
    b = e.select("night_id", c("det_id").alias("j"), c("tc").alias("tj"), c("w").alias("wj"), c("d").alias("dj"), c("e").alias("ej"), c("low").alias("lj"), "kw", "kd")
    alike = "i <> j and abs(ln(di / dj)) < ln(2D) and (abs(ln(wi / wj)) < ln(1.5D) or (li and ln(wi / wj) <= ln(1.5D)) or (lj and ln(wj / wi) <= ln(1.5D)))"
    near = a.join(b, ["night_id", "kw", "kd"]).filter("any or lj").filter(alike)
    span = events(t).groupBy("night_id").agg(F.min("tc").alias("e0"), F.max("tc").alias("e1")).join(cadence(t), "night_id", "left")
    span = span.select("night_id", F.least("e0", "t_first").alias("lo"), F.greatest("e1", "t_last").alias("hi"), F.coalesce("cadence", F.lit(0.0)).alias("cadence"))
    win = F.greatest(0.1 * F.least("wi", "wj"), 2 * F.hypot("ei", "ej"), c("cadence"))
    share = (F.least(c("ti") + win, c("hi")) - F.greatest(c("ti") - win, c("lo"))) / (c("hi") - c("lo"))
    share = F.when(c("hi") > c("lo"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))).otherwise(1.0)
    return near.join(span, "night_id").select("night_id", "i", "j", (F.abs(c("ti") - c("tj")) <= win).alias("close"), share.alias("share"))


_COINC = f"""{_EVENTS},
d0 AS (SELECT night_id, bjd_tdb AS t, bjd_tdb - lag(bjd_tdb) OVER (PARTITION BY night_id ORDER BY bjd_tdb) AS d FROM fr WHERE bjd_tdb IS NOT NULL),
cad AS (SELECT night_id, min(t) AS t0, max(t) AS t1, median(d) AS cad FROM d0 GROUP BY 1),
sp AS (SELECT e.night_id, least(min(tc), any_value(t0)) AS lo, greatest(max(tc), any_value(t1)) AS hi, coalesce(any_value(cad), 0) AS cad FROM ev e LEFT JOIN cad USING (night_id) GROUP BY 1),
pr AS (SELECT a.night_id, a.det_id AS i, greatest(0.1 * least(a.w, b.w), 2 * sqrt(a.e ** 2 + b.e ** 2), cad) AS win, abs(a.tc - b.tc) AS dt, a.tc, lo, hi FROM ev a JOIN ev b ON a.night_id = b.night_id AND a.det_id <> b.det_id JOIN sp ON sp.night_id = a.night_id
  WHERE (abs(ln(a.w / b.w)) < ln(1.5) OR (a.low AND ln(a.w / b.w) <= ln(1.5)) OR (b.low AND ln(b.w / a.w) <= ln(1.5))) AND abs(ln(a.d / b.d)) < ln(2)),
ps AS (SELECT night_id, i, dt <= win AS close, CASE WHEN hi > lo THEN least(1, greatest(0, (least(tc + win, hi) - greatest(tc - win, lo)) / (hi - lo))) ELSE 1 END AS share FROM pr),
co AS (SELECT ev.night_id, det_id, count(*) FILTER (WHERE close) AS n_similar, count(i) AS m, coalesce(avg(share), 0) AS p FROM ev LEFT JOIN ps ON i = det_id AND ps.night_id = ev.night_id GROUP BY 1, 2),
ch AS (SELECT *, CASE WHEN n_similar = 0 OR p >= 1 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(range(0, n_similar), lambda k: exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) + k * ln(p) + (m - k) * ln(1 - p))))) END AS p_chance FROM co)"""


def coincidences(t: Inputs) -> DataFrame:
    """Every timed event: look-alikes of its night at its time (n_similar), at any time (m), their mean chance to be at its time (p)."""
    g = lookalikes(t).groupBy("night_id", c("i").alias("det_id"))
    g = g.agg(F.count_if("close").alias("n_similar"), F.count("*").alias("m"), F.avg("share").alias("p"))
    zero = F.lit(0).cast("long")
    return events(t).select("night_id", "det_id").join(g, ["night_id", "det_id"], "left").select(
        "night_id", "det_id", F.coalesce("n_similar", zero).alias("n_similar"), F.coalesce("m", zero).alias("m"), F.coalesce("p", F.lit(0.0)).alias("p")
    )


def chances(t: Inputs) -> DataFrame:
    """``coincidences`` with the chance of so many look-alikes, and whether that rejects the event: three at least, by chance in one of a thousand."""
    p = F.when(c("n_similar") > 0, X.binomial_sf(c("n_similar"), c("m"), c("p"))).otherwise(1.0)
    return coincidences(t).withColumn("p_chance", p).withColumn("rejected", (c("n_similar") >= 3) & (c("p_chance") < 1e-3))


@query("j23_g13_coincidence", f"""
WITH {_COINC} SELECT night_id, det_id, n_similar, m, round(m * p, 5) AS n_expected, round(p_chance, 5) AS p_chance, n_similar >= 3 AND p_chance < 1e-3 AS rejected FROM ch""")
def _(t: Inputs) -> DataFrame:
    return chances(t).select("night_id", "det_id", "n_similar", "m", r6(c("m") * c("p"), "n_expected", 5), r6(c("p_chance"), "p_chance", 5), "rejected")


@query("x25_coincidence_chance", f"WITH {_COINC} SELECT det_id, round(p_chance, 5) AS p_chance FROM ch")
def _(t: Inputs) -> DataFrame:
    return chances(t).select("det_id", r6(c("p_chance"), "p_chance", 5))


_MATCH = """
ok AS (SELECT shape_id, obj_id, tc, depth, t14_h, t14_lower_limit FROM shape WHERE converged AND tc IS NOT NULL AND depth > 0 AND t14_h > 0),
zs AS (SELECT a.obj_id, a.shape_id AS a, b.shape_id AS b, abs(a.tc - b.tc) AS dt, (a.depth - b.depth) / (0.05 * 0.5 * (a.depth + b.depth)) AS zd,
  CASE WHEN a.t14_lower_limit AND b.t14_lower_limit THEN NULL WHEN a.t14_lower_limit THEN greatest(a.t14_h - b.t14_h, 0) WHEN b.t14_lower_limit THEN greatest(b.t14_h - a.t14_h, 0) ELSE a.t14_h - b.t14_h END
    / (0.1 * 0.5 * (a.t14_h + b.t14_h)) AS zt FROM ok a JOIN ok b ON a.obj_id = b.obj_id AND a.shape_id < b.shape_id),
pr AS (SELECT * FROM zs WHERE abs(zd) <= 3 AND coalesce(abs(zt) <= 3, true))"""


def matching_shapes(t: Inputs, most_z: float = 3.0) -> DataFrame:
    """Pairs of converged shapes of one object whose depths and durations agree within ``most_z`` systematic floors.

    A lower-limit duration only counts against a shorter partner; two of them say nothing.  Depths that agree lie in
    the same or a neighbouring class of ln depth, so only such pairs are formed.
    """
    width = 2 * math.atanh(0.5 * 0.05 * most_z) * 1.0001  # |a - b| = z * 0.05 * (a + b) / 2 as a difference of logarithms
    ok = t.shape.filter("converged and tc is not null and depth > 0 and t14_h > 0").withColumn("k", F.floor(F.log("depth") / width))
    cols = ["shape_id", "tc", "depth", "t14_h", "t14_lower_limit"]
    a, b = (ok.select("obj_id", "k", *(c(k).alias(f"{s}_{k}") for k in cols)) for s in "ab")
    a = a.withColumn("k", F.explode(F.array(*(c("k") + s for s in (-1, 0, 1)))))
    p = a.join(b, ["obj_id", "k"]).filter("a_shape_id < b_shape_id")
    diff, low_a, low_b = c("a_t14_h") - c("b_t14_h"), c("a_t14_lower_limit"), c("b_t14_lower_limit")
    sided = F.when(low_a & low_b, None).when(low_a, F.greatest(diff, F.lit(0.0))).when(low_b, F.greatest(-diff, F.lit(0.0))).otherwise(diff)
    zd = (c("a_depth") - c("b_depth")) / (0.05 * 0.5 * (c("a_depth") + c("b_depth")))
    zt = sided / (0.1 * 0.5 * (c("a_t14_h") + c("b_t14_h")))
    z = p.select("obj_id", c("a_shape_id").alias("a"), c("b_shape_id").alias("b"), F.abs(c("a_tc") - c("b_tc")).alias("dt"), zd.alias("zd"), zt.alias("zt"))
    return z.filter((F.abs("zd") <= most_z) & F.coalesce(F.abs("zt") <= most_z, F.lit(True)))


@query("j25_g12_shape_pairs", f"""
WITH {_MATCH} SELECT a, b, round(dt, 5) AS dt, round(coalesce(zd ** 2, 0) + coalesce(zt ** 2, 0), 4) AS chi2, (zd IS NOT NULL)::INT + (zt IS NOT NULL)::INT AS dof,
  round(CASE WHEN zd IS NOT NULL AND zt IS NOT NULL THEN exp(-(zd ** 2 + zt ** 2) / 2) END, 6) AS p_two FROM pr""")
def _(t: Inputs) -> DataFrame:
    chi2 = F.coalesce(c("zd") ** 2, F.lit(0.0)) + F.coalesce(c("zt") ** 2, F.lit(0.0))
    dof = c("zd").isNotNull().cast("int") + c("zt").isNotNull().cast("int")
    p = matching_shapes(t).withColumns({"chi2": chi2, "dof": dof})
    two = F.when(c("dof") == 2, X.chi2_sf(c("chi2"), c("dof")))
    return p.select("a", "b", r6(c("dt"), "dt", 5), r6(c("chi2"), "chi2", 4), "dof", r6(two, "p_two"))


@query("x17_commensurate_periods", f"""
WITH {_MATCH}, k AS (SELECT a, b, dt, unnest(range(1, 1 + least(50, greatest(0, floor(dt / 0.2)))::INT)) AS k FROM pr)
SELECT a, b, count(*) AS n, round(max(dt / k), 5) AS longest, round(min(dt / k), 5) AS shortest FROM k GROUP BY 1, 2""")
def _(t: Inputs) -> DataFrame:
    p = matching_shapes(t).withColumn("p", X.commensurate(c("dt"), 0.2)).filter(F.size("p") > 0)
    return p.select("a", "b", F.size("p").cast("long").alias("n"), r6(F.array_max("p"), "longest", 5), r6(F.array_min("p"), "shortest", 5))


@query("j26_nearest_event", """
WITH d AS (SELECT det_id, obj_id, tc_bjd_tdb AS t FROM det WHERE kind = 'transit' AND tc_bjd_tdb IS NOT NULL),
v AS (SELECT DISTINCT review_id, obj_id, tc_bjd_tdb AS tc FROM detection_review_orphan WHERE kind = 'transit' AND tc_bjd_tdb IS NOT NULL AND NOT isnan(tc_bjd_tdb)),
r AS (SELECT review_id, det_id, row_number() OVER (PARTITION BY review_id ORDER BY abs(t - tc), det_id) AS r FROM v JOIN d USING (obj_id) WHERE abs(t - tc) <= 0.5)
SELECT review_id, det_id FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    # Buckets of the tolerance: a left row looks into three of them, so the join has equality keys.
    v = t.table("detection_review_orphan").filter("kind = 'transit' and tc_bjd_tdb is not null and not isnan(tc_bjd_tdb)")
    v = v.select("review_id", "obj_id", c("tc_bjd_tdb").alias("tc")).distinct()
    v = v.withColumn("k", F.explode(F.array(*(F.floor(c("tc") / 0.5) + s for s in (-1, 0, 1)))))
    d = t.det.filter("kind = 'transit' and tc_bjd_tdb is not null").select("det_id", "obj_id", c("tc_bjd_tdb").alias("t"), F.floor(c("tc_bjd_tdb") / 0.5).alias("k"))
    near = v.join(d, ["obj_id", "k"]).withColumn("gap", F.abs(c("t") - c("tc"))).filter("gap <= 0.5")
    return near.groupBy("review_id").agg(F.min(F.struct("gap", "det_id")).alias("b")).select("review_id", "b.det_id")


@query("j27_frame_lookup", """
WITH a AS (SELECT night_id, frame_index, count(*) AS n_absent FROM matched_epoch WHERE flags = -1 GROUP BY 1, 2)
SELECT night_id, a.frame_index, n_absent, file_name FROM a LEFT JOIN frame f USING (night_id, frame_index)""")
def _(t: Inputs) -> DataFrame:
    absent = t.table("matched_epoch").filter("flags = -1").groupBy("night_id", "frame_index").agg(F.count("*").alias("n_absent"))
    return absent.join(t.table("frame").select("night_id", "frame_index", "file_name"), ["night_id", "frame_index"], "left")


@query("j30_majority_vote", """
WITH n AS (SELECT target, filter_band, count(*) AS n, min(night_id) AS f FROM night WHERE filter_band IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, f) AS r FROM n) SELECT target, filter_band, n FROM r WHERE r = 1""")
def _(t: Inputs) -> DataFrame:
    n = t.night.filter("filter_band is not null").groupBy("target", "filter_band").agg(F.count("*").alias("n"), F.min("night_id").alias("f"))
    return R.argmax(n, ["target"], [F.desc("n"), c("f")]).select("target", "filter_band", "n")


@query("j33_tiles", """
WITH x AS (SELECT floor(ra / 10)::INT AS tx, floor((dec + 90) / 10)::INT AS ty FROM pos) SELECT tx, ty, count(*) AS n FROM x GROUP BY 1, 2""")
def _(t: Inputs) -> DataFrame:
    return t.pos.groupBy(F.floor(c("ra") / 10).cast("int").alias("tx"), F.floor((c("dec") + 90) / 10).cast("int").alias("ty")).agg(F.count("*").alias("n"))


@query("o1_o3_sorted_page", "SELECT obj_id, round(mag, 4) AS mag FROM obj ORDER BY mag DESC NULLS LAST, obj_id LIMIT 50 OFFSET 25")
def _(t: Inputs) -> DataFrame:
    return t.obj.orderBy(F.desc_nulls_last("mag"), "obj_id").offset(25).limit(50).select("obj_id", r6(c("mag"), "mag", 4))


@query("o4_o7_top_n", """
WITH r AS (SELECT night_id, det_id, row_number() OVER (PARTITION BY night_id ORDER BY snr DESC NULLS LAST, det_id) AS r FROM det WHERE night_id IS NOT NULL) SELECT night_id, det_id, r FROM r WHERE r <= 5""")
def _(t: Inputs) -> DataFrame:
    w = Window.partitionBy("night_id").orderBy(F.desc_nulls_last("snr"), "det_id")
    return t.det.filter("night_id is not null").select("night_id", "det_id", F.row_number().over(w).alias("r")).filter("r <= 5")


@query("u1_union_distinct", """
SELECT obj_id, night_id FROM detection_review_orphan WHERE night_id IS NOT NULL UNION SELECT obj_id, night_id FROM det WHERE night_id IS NOT NULL AND status IN ('CONFIRMED', 'REJECTED')""")
def _(t: Inputs) -> DataFrame:
    a = t.table("detection_review_orphan").filter("night_id is not null").select("obj_id", "night_id")
    return a.unionByName(t.det.filter("night_id is not null and status in ('CONFIRMED', 'REJECTED')").select("obj_id", "night_id")).distinct()


@query("u2_union_all", """
SELECT obj_id, 'object' AS origin, known_type AS kind FROM sky_object UNION ALL SELECT cat_id, 'catalogue', var_type FROM catalog_source""")
def _(t: Inputs) -> DataFrame:
    a = t.table("sky_object").select("obj_id", F.lit("object").alias("origin"), c("known_type").alias("kind"))
    return a.unionByName(t.table("catalog_source").select(c("cat_id").alias("obj_id"), F.lit("catalogue").alias("origin"), c("var_type").alias("kind")))


@query("u3_set_operations", """
(SELECT obj_id FROM det INTERSECT SELECT obj_id FROM shape) EXCEPT SELECT obj_id FROM detection_review_orphan""")
def _(t: Inputs) -> DataFrame:
    return t.det.select("obj_id").intersect(t.shape.select("obj_id")).subtract(t.table("detection_review_orphan").select("obj_id"))


@query("x1_x27_magnitudes", """
SELECT night_id, star_id, round(zp - 2.5 * log10(f), 4) AS mag, round(2.5 / ln(10) * e / f, 5) AS err FROM
(SELECT night_id, star_id, median(flux) AS f, median(fluxerr) AS e FROM ep WHERE aper = 0 GROUP BY 1, 2) JOIN night USING (night_id)""")
def _(t: Inputs) -> DataFrame:
    s = t.ep.filter("aper = 0").groupBy("night_id", "star_id").agg(R.median("flux").alias("f"), R.median("fluxerr").alias("e"))
    mag = c("zp").cast("double") + X.magnitude(c("f"))
    return s.join(t.night.select("night_id", "zp"), "night_id").select("night_id", "star_id", r6(mag, "mag", 4), r6(X.magnitude_error(c("f"), c("e")), "err", 5))


@query("x4_object_names", """
WITH u AS (SELECT obj_id, floor((ra / 15) * 36000 + 0.5)::BIGINT AS r, floor(abs(dec) * 3600 + 0.5)::BIGINT AS d, dec FROM pos)
SELECT obj_id, 'RP J' || lpad((r // 36000 % 24)::VARCHAR, 2, '0') || lpad((r // 600 % 60)::VARCHAR, 2, '0') || lpad((r % 600 // 10)::VARCHAR, 2, '0') || '.' || (r % 10)::VARCHAR
  || CASE WHEN dec < 0 THEN '-' ELSE '+' END || lpad((d // 3600)::VARCHAR, 2, '0') || lpad((d // 60 % 60)::VARCHAR, 2, '0') || lpad((d % 60)::VARCHAR, 2, '0') AS made FROM u""")
def _(t: Inputs) -> DataFrame:
    return t.pos.select("obj_id", X.object_name(c("ra"), c("dec")).alias("made"))


@query("x5_sexagesimal", r"""
WITH p AS (SELECT cat_id, dec_text, regexp_extract_all(dec_text, '[0-9]+(?:\.[0-9]*)?') AS p FROM catalog_source WHERE dec_text IS NOT NULL)
SELECT cat_id, round((CASE WHEN ltrim(dec_text) LIKE '-%' THEN -1 ELSE 1 END) * CASE len(p) WHEN 1 THEN p[1]::DOUBLE WHEN 3 THEN p[1]::DOUBLE + p[2]::DOUBLE / 60 + p[3]::DOUBLE / 3600 END, 7) AS dec FROM p""")
def _(t: Inputs) -> DataFrame:
    return t.table("catalog_source").filter("dec_text is not null").select("cat_id", r6(X.sexagesimal(c("dec_text")), "dec", 7))


@query("x6_label_date", r"""
SELECT night_id, coalesce(try_strptime(nullif(regexp_extract(label, '^(\d{8})(?:\D|$)', 1), ''), '%Y%m%d')::DATE, night_date) AS at FROM night""")
def _(t: Inputs) -> DataFrame:
    return t.night.select("night_id", X.label_date(c("label"), c("night_date")).alias("at"))


@query("x8_flag_masks", """
SELECT det_id, (CASE WHEN list_contains(f, 'EDGE') THEN 1 ELSE 0 END) + (CASE WHEN list_contains(f, 'PARTIAL') THEN 16 ELSE 0 END) + (CASE WHEN list_contains(f, 'SHARED_EPOCH') THEN 128 ELSE 0 END) AS bits
FROM (SELECT det_id, string_split(coalesce(flags, ''), '|') AS f FROM det)""")
def _(t: Inputs) -> DataFrame:
    return t.det.select("det_id", X.flag_bits(c("flags")).bitwiseAND(1 | 16 | 128).alias("bits"))


@query("x9_duration_text", "SELECT shape_id, CASE WHEN t14_lower_limit THEN '≥ ' ELSE '' END || printf('%.3f h', t14_h) AS shown FROM shape WHERE t14_h IS NOT NULL AND t14_lower_limit IS NOT NULL")
def _(t: Inputs) -> DataFrame:
    return t.shape.filter("t14_h is not null and t14_lower_limit is not null").select(
        "shape_id", F.concat(F.when(c("t14_lower_limit"), "≥ ").otherwise(""), F.format_string("%.3f h", "t14_h")).alias("shown")
    )


@query("x12_finite_reals", "SELECT frame_id, CASE WHEN airmass IS NOT NULL AND abs(airmass) BETWEEN 1e-300 AND 1e-30 THEN sign(airmass) * 1e-30 ELSE round(airmass, 6) END AS airmass FROM fr")
def _(t: Inputs) -> DataFrame:
    x = c("airmass")
    return t.fr.select("frame_id", F.when((F.abs(x) >= 1e-300) & (F.abs(x) <= 1e-30), F.signum(x) * 1e-30).otherwise(F.round(x, 6)).alias("airmass"))


@query("x13_json_fields", "SELECT event_id, (props ->> '$.k')::DOUBLE AS k FROM events")
def _(t: Inputs) -> DataFrame:
    return t.table("events").select("event_id", F.get_json_object("props", "$.k").cast("double").alias("k"))


@query("x15_merge_tokens", """
SELECT o.obj_id, array_to_string(list_filter(list_distinct_in_order, lambda x: x <> ''), '|') AS types FROM
(SELECT obj_id, CASE WHEN coalesce(known_type, '') = coalesce(obj_class, '') THEN [coalesce(known_type, '')] ELSE [coalesce(known_type, ''), coalesce(obj_class, '')] END AS list_distinct_in_order FROM sky_object) o""")
def _(t: Inputs) -> DataFrame:
    return t.table("sky_object").select("obj_id", X.merge_tokens(c("known_type"), c("obj_class")).alias("types"))


@query("x16_clean_names", "SELECT obj_id, CASE WHEN trim(known_name) IN ('', '-', '?', 'None', 'nan') THEN '' ELSE coalesce(trim(known_name), '') END AS clean FROM sky_object")
def _(t: Inputs) -> DataFrame:
    n = F.trim("known_name")
    return t.table("sky_object").select("obj_id", F.when(n.isin("", "-", "?", "None", "nan"), "").otherwise(F.coalesce(n, F.lit(""))).alias("clean"))


@query("x18_frequency_grid", """
SELECT obj_id, 1 / greatest(period * 10, 1) AS fmin, least(floor((50 - 1 / greatest(period * 10, 1)) / 0.0001)::BIGINT + 1, 200000) AS n, floor((50 - 1 / greatest(period * 10, 1)) / 0.0001)::BIGINT + 1 > 200000 AS coarsened FROM obj WHERE period > 0""")
def _(t: Inputs) -> DataFrame:
    low = 1 / F.greatest(c("period") * 10, F.lit(1.0))
    grid = X.frequency_grid(low, F.lit(50.0), F.lit(0.0001))
    return t.obj.filter("period > 0").select("obj_id", grid.alias("g")).select("obj_id", "g.fmin", "g.n", "g.coarsened")


@query("x19_harmonics", "SELECT obj_id, round(least(abs(period / 0.5 - 1.3), abs(period - 1.3), abs(period / 2 - 1.3)) / 1.3, 6) AS off FROM obj WHERE period > 0")
def _(t: Inputs) -> DataFrame:
    return t.obj.filter("period > 0").select("obj_id", r6(X.harmonic_offset(c("period"), F.lit(1.3)), "off"))


@query("x20_trapezoid", """
SELECT shape_id, round(greatest(0, least(1, (t14_h / 48 - abs(0.02)) / 0.01)), 6) AS dip FROM shape WHERE t14_h IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    return t.shape.filter("t14_h is not null").select("shape_id", r6(X.trapezoid(F.lit(0.02), F.lit(0.0), c("t14_h") / 24, F.lit(0.01)), "dip"))


@query("s13_mid_exposure", """
SELECT frame_id, round(epoch_us(date_obs) / 86400e6 + 2440587.5 + coalesce(CASE WHEN isnan(exptime) THEN NULL ELSE exptime END, 0)::DOUBLE / 172800, 6) AS jd FROM frame WHERE date_obs IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    return t.table("frame").filter("date_obs is not null").select("frame_id", r6(X.julian_date(c("date_obs").cast("timestamp"), X.clean(c("exptime"))), "jd"))


@query("s15_first_present_column", "SELECT cat_id, coalesce(designation, alias, source_ref) AS label FROM catalog_source")
def _(t: Inputs) -> DataFrame:
    from lightloom.sources.tables import first_present

    return t.table("catalog_source").select("cat_id", F.col("designation").alias("label")).drop("label").join(
        first_present(t.table("catalog_source"), "label", ["designation", "no_such_column", "alias", "source_ref"]).select("cat_id", "label"), "cat_id"
    )


@query("k5_upsert", """
WITH new AS (SELECT star_id, count(*) AS n FROM ep GROUP BY 1) SELECT obj_id AS star_id, 0 AS n FROM sky_object WHERE obj_id NOT IN (SELECT star_id FROM new) UNION ALL SELECT * FROM new""")
def _(t: Inputs) -> DataFrame:
    old = t.table("sky_object").select(c("obj_id").alias("star_id"), F.lit(0).cast("long").alias("n"))
    return store.upsert(old, t.ep.groupBy("star_id").agg(F.count("*").alias("n")), ["star_id"])


@query("k6_t5_reload", """
WITH again AS (SELECT night_id FROM night WHERE removed_at IS NULL AND zp_source = 'gaia')
SELECT det_id, status FROM det WHERE night_id IS NULL OR night_id NOT IN (SELECT night_id FROM again) OR coalesce(status, '') = 'CONFIRMED'
UNION ALL SELECT night_id::BIGINT, 'RELOADED' FROM again""")
def _(t: Inputs) -> DataFrame:
    fresh = t.night.filter("removed_at is null and zp_source = 'gaia'").select("night_id", c("night_id").cast("long").alias("det_id"), F.lit("RELOADED").alias("status"))
    old = t.det.select("det_id", "night_id", "status")
    return store.reload(old, fresh, "night_id", F.coalesce(c("status"), F.lit("")) != "CONFIRMED").select("det_id", "status")


@query("k7_cascade_delete", """
SELECT det_id FROM det WHERE night_id IS NULL OR night_id IN (SELECT night_id FROM night WHERE removed_at IS NULL)""")
def _(t: Inputs) -> DataFrame:
    return store.cascade(t.det.select("det_id", "night_id"), t.night.filter("removed_at is null"), "night_id").select("det_id")


@query("k7_orphan_objects", """
SELECT obj_id FROM sky_object o WHERE NOT known AND NOT EXISTS (SELECT 1 FROM matched_epoch e WHERE e.star_id = o.obj_id)
  AND NOT EXISTS (SELECT 1 FROM detection d WHERE d.obj_id = o.obj_id) AND NOT EXISTS (SELECT 1 FROM transit_shape s WHERE s.obj_id = o.obj_id)""")
def _(t: Inputs) -> DataFrame:
    children = [(t.table("matched_epoch"), "star_id"), (t.table("detection"), "obj_id"), (t.table("transit_shape"), "obj_id")]
    return store.unreferenced(t.table("sky_object"), "obj_id", children, ~c("known")).select("obj_id")


@query("k8_fill_nulls", """
SELECT o.obj_id, coalesce(nullif(o.known_type, ''), k.kind) AS known_type FROM sky_object o LEFT JOIN (SELECT obj_id, min(kind) AS kind FROM det GROUP BY 1) k USING (obj_id)""")
def _(t: Inputs) -> DataFrame:
    old = t.table("sky_object").select("obj_id", F.when(c("known_type") != "", c("known_type")).alias("known_type"))
    return store.fill(old, t.det.groupBy("obj_id").agg(F.min("kind").alias("known_type")), "obj_id", ["known_type"])
