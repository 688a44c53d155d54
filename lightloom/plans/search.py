"""The search interface: filters, columns, whitelisted sorting, pages, details of an object, and guarded ad-hoc SQL."""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lightloom.functions import scalar as X
from lightloom.operators import sky
from lightloom.plans.registry import INPUTS, ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.results import (
    _ROUNDED, best_matches, catalogue_entries, combined_peaks, detections, latest, objects, period_estimates, requests, reviews, rounded, rounded_sql, star_nights,
)
from lightloom.plans.relational import chances
from lightloom.plans.statistics import r6

c = F.col
CLASSES = ("UNC", "EXOP", "VAR", "EXOP+VAR")
STATUSES = ("UNCONFIRMED", "CONFIRMED", "REJECTED")
#: Kinds of detection, and where they were found.
KINDS, SCOPES = ("transit", "variable", "internight", "ls_periodic", "bls", "recurrent"), ("night", "multinight")
#: The columns of an answer, those of an object and those derived for it.
COLUMNS = (
    "obj_id", "name", "ra", "dec", "class", "is_exop", "is_var", "known", "source_db", "known_name", "known_type", "period", "period_err", "period_source", "known_period", "mean_mag", "n_nights", "best_snr",
    "depth", "duration_h", "duration_lower_limit", "amplitude", "status", "first_night", "last_night", "n_review_pending", "n_nights_reviewed",
)
DERIVED = (
    "n_transit_events", "max_p_match", "period_delta", "period_delta_err", "period_verify_status", "period_verify_note", "mean_mag_app", "mag_zp_source", "n_rerun_pending", "last_rerun_status",
    "last_rerun_finished_at",
)
SORTS = (*COLUMNS, *DERIVED)
#: Rows of an answer to ad-hoc SQL (one more is asked for, to tell a cut answer) and the seconds it may take.
MOST_ROWS, MOST_SECONDS = 5000, 30


@dataclass(frozen=True)
class Filters:
    """All filters are optional and combined by AND; None does not filter."""

    classes: tuple[str, ...] | None = None
    is_exop: bool | None = None
    is_var: bool | None = None
    min_p_match: float | None = None  #: least probability of the best pair of shapes
    known: bool | None = None
    source_db: str | None = None
    status: str | None = None
    needs_review: bool | None = None
    user_reviewed: bool | None = None
    rerun_pending: bool | None = None
    telescope: str | None = None
    name: str | None = None
    gaia_id: str | None = None
    cone: tuple[float, float, float] | None = None  #: ra, dec in degrees, radius in arcseconds
    mag_min: float | None = None
    mag_max: float | None = None
    period_min: float | None = None
    period_max: float | None = None
    snr_min: float | None = None
    depth_min: float | None = None
    tier_max: int | None = None
    n_nights_min: int | None = None
    night_from: str | None = None
    night_to: str | None = None
    has_periodogram: bool | None = None
    detection_kinds: tuple[str, ...] | None = None
    detection_scope: str | None = None


def check(f: Filters) -> None:
    """Refuses values outside the known ones before anything is planned."""
    for given, known in ((f.classes, CLASSES), (f.detection_kinds, KINDS), (f.status and (f.status,), STATUSES), (f.detection_scope and (f.detection_scope,), SCOPES)):
        if given and not set(given) <= set(known):
            raise ValueError(f"unknown value in {given}; known are {known}")


def predicate(f: Filters) -> Column:
    """The filters on an object's own columns."""
    check(f)
    parts = [c("class").isin(*f.classes)] if f.classes else []
    for wanted, column in ((f.is_exop, "is_exop"), (f.is_var, "is_var"), (f.known, "known")):
        parts += [c(column) == wanted] if wanted is not None else []
    for wanted, column in ((f.needs_review, "n_review_pending"), (f.user_reviewed, "n_nights_reviewed")):
        parts += [(c(column) > 0) == wanted] if wanted is not None else []
    parts += [c("status") == f.status] if f.status else []
    for text, column in ((f.name, "name"), (f.gaia_id, "gaia_id"), (f.source_db, "source_db")):
        parts += [F.contains(F.lower(column), F.lit(text.lower()))] if text else []
    ranges = ((f.mag_min, f.mag_max, "mean_mag"), (f.period_min, f.period_max, "period"), (f.n_nights_min, None, "n_nights"), (f.snr_min, None, "best_snr"), (f.depth_min, None, "depth"))
    for low, high, column in ranges:
        parts += [c(column) >= low] if low is not None else []
        parts += [c(column) <= high] if high is not None else []
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def _exists(obj: DataFrame, rows: DataFrame, wanted: bool = True) -> DataFrame:
    return obj.join(rows.select("obj_id"), "obj_id", "left_semi" if wanted else "left_anti")


def asked_columns(f: Filters) -> set[str]:
    """The derived columns that the filters look at."""
    looks = {
        "class": f.classes, "is_exop": f.is_exop, "is_var": f.is_var, "known": f.known, "source_db": f.source_db, "n_review_pending": f.needs_review, "n_nights_reviewed": f.user_reviewed, "best_snr": f.snr_min,
        "depth": f.depth_min, "n_nights": f.n_nights_min,
    } | {n: (a, b) if (a, b) != (None, None) else None for n, a, b in (("mean_mag", f.mag_min, f.mag_max), ("period", f.period_min, f.period_max))}
    return {n for n, given in looks.items() if given is not None}


def matching(t: Inputs, f: Filters = Filters(), columns: set[str] | None = None) -> DataFrame:
    """The objects that pass all filters, with all columns or those that are named and asked for."""
    obj = objects(t, None if columns is None else columns | asked_columns(f)).filter(predicate(f))
    obj = obj if f.cone is None else sky.cone(obj.filter("ra is not null"), f.cone[0], f.cone[1], f.cone[2] / 3600)
    if f.min_p_match is not None:
        obj = _exists(obj, best_matches(t).filter(c("p_match") >= f.min_p_match))
    if f.rerun_pending is not None:
        obj = _exists(obj, requests(t).filter("status in ('queued', 'running')"), f.rerun_pending)
    if f.tier_max is not None:
        obj = _exists(obj, detections(t).filter((c("kind") == "transit") & (c("tier") <= f.tier_max)))
    if f.telescope or f.night_from or f.night_to:
        # The telescope and the dates are asked for by themselves: any night of each.
        nights = t.ep.filter("aper = 0").select(c("star_id").alias("obj_id"), "night_id").distinct().join(t.night.select("night_id", "telescope", "night_date"), "night_id")
        obj = _exists(obj, nights.filter(c("telescope") == f.telescope)) if f.telescope else obj
        dated = nights.filter(c("night_date") >= F.lit(f.night_from).cast("date")) if f.night_from else nights
        dated = dated.filter(c("night_date") <= F.lit(f.night_to).cast("date")) if f.night_to else dated
        obj = _exists(obj, dated) if f.night_from or f.night_to else obj
    if f.has_periodogram is not None:
        obj = _exists(obj, combined_peaks(t), f.has_periodogram)
    if f.detection_kinds:
        asked = t.det.filter(c("kind").isin(*f.detection_kinds))
        asked = asked.filter(f"{'night_id' if f.detection_scope == 'night' else 'mn_run_id'} is not null") if f.detection_scope else asked
        obj = _exists(obj, asked)
    return obj


def verifications(t: Inputs) -> DataFrame:
    """The latest period estimate of each object whose period is known otherwise, and how far it is off."""
    known = t.obj.filter("period is not null").select("obj_id", c("period").alias("lit"))
    rows = latest(period_estimates(t).join(known, "obj_id"), "obj_id", "computed_at", "n_nights", "est_id")
    error = F.hypot(c("period_err"), c("lit") * 1e-4)
    return rows.select("obj_id", (c("period") - c("lit")).alias("period_delta"), error.alias("period_delta_err"), c("verify_status").alias("period_verify_status"),
                       F.concat(c("n_nights").cast("string"), F.lit(" points")).alias("period_verify_note"))


def apparent(t: Inputs) -> DataFrame:
    """Mean apparent magnitude over an object's nights, and where their zero points come from."""
    rows = star_nights(t).join(t.night.select("night_id", "zp", "zp_source"), "night_id").filter("mag is not null")
    kinds = F.countDistinct("zp_source")
    return rows.groupBy("obj_id").agg(F.avg(c("mag") + c("zp").cast("double")).alias("mean_mag_app"), F.when(kinds == 1, F.min("zp_source")).otherwise("mixed").alias("mag_zp_source"))


def reruns(t: Inputs) -> DataFrame:
    newest = F.max(F.struct("requested_at", "req_id", "status", "finished_at"))
    rows = requests(t).groupBy("obj_id").agg(F.count_if(c("status").isin("queued", "running")).alias("n_rerun_pending"), newest.alias("l"))
    return rows.select("obj_id", "n_rerun_pending", c("l.status").alias("last_rerun_status"), c("l.finished_at").alias("last_rerun_finished_at"))


def search(t: Inputs, f: Filters = Filters()) -> DataFrame:
    """Objects that pass all filters, with every column of an answer; ``page`` sorts and cuts."""
    out = matching(t, f)
    best = best_matches(t).withColumnRenamed("p_match", "max_p_match")
    for part in (best, verifications(t), apparent(t), reruns(t)):
        out = out.join(part, "obj_id", "left")
    out = out.withColumns({n: F.coalesce(n, F.lit(0).cast("long")) for n in ("n_transit_events", "n_rerun_pending")})
    shown = F.when(c("duration_h").isNotNull(), F.concat(F.when(c("duration_lower_limit"), "≥ ").otherwise(""), F.format_string("%.2f h", "duration_h")))
    return out.select(*COLUMNS, *DERIVED, shown.alias("duration_display"))


def page(rows: DataFrame, sort: str = "obj_id", descending: bool = False, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page in an order with missing values last and obj_id as tie-break; Spark keeps only offset + limit rows a task."""
    if sort not in SORTS or not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("sort by a known column; 1 to 1000 rows from 0 on")
    order = F.desc_nulls_last(sort) if descending else F.asc_nulls_last(sort)
    return rows.orderBy(order, "obj_id").offset(offset).limit(limit)


def write_csv(rows: DataFrame, path: str) -> None:
    """An answer as CSV files with a header, written by its partitions; missing values are empty."""
    rows.write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path)


def _nodes(plan):
    yield plan
    for group in (plan.children(), plan.innerChildren()):
        for k in range(group.size()):
            if hasattr(group.apply(k), "children"):
                yield from _nodes(group.apply(k))


def read_only(spark: SparkSession, text: str) -> str:
    """The one statement of a text, if it only reads; parsed, not planned, so nothing is run to find out."""
    bare = re.sub(r"--[^\n]*|/\*.*?\*/", " ", text, flags=re.S).strip().rstrip(";").strip()
    if not re.match(r"(?i)(select|with|values|from|table|\()", bare):
        raise ValueError("one SELECT at a time")
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(bare)
    except Exception as e:
        raise ValueError("one SELECT at a time") from e
    of = spark._jvm.java.lang.Class.forName
    refused = [of("org.apache.spark.sql.catalyst.plans.logical." + n) for n in ("Command", "ParsedStatement", "InsertIntoStatement")]
    if any(r.isInstance(node) for node in _nodes(plan) for r in refused):
        raise ValueError("read only")
    return bare


def run_sql(spark: SparkSession, text: str) -> tuple[DataFrame, bool]:
    """(rows, cut): one read-only statement, run once; ``MOST_ROWS`` rows of its answer at most, cancelled after ``MOST_SECONDS``."""
    df = spark.sql(read_only(spark, text))
    group, context = uuid.uuid4().hex, spark.sparkContext
    context.setJobGroup(group, "ad-hoc query", interruptOnCancel=True)
    timer = threading.Timer(MOST_SECONDS, context.cancelJobGroup, [group])
    timer.start()
    try:
        rows = df.limit(MOST_ROWS + 1).collect()  # bounded by the answer's size
    finally:
        timer.cancel()
        context.setLocalProperty("spark.jobGroup.id", None)
    return spark.createDataFrame(rows[:MOST_ROWS], df.schema), len(rows) > MOST_ROWS


# ---- queries -------------------------------------------------------------------------------------------------------------

INPUTS["pv"] = """SELECT obj_id, period - lit AS period_delta, sqrt(period_err ** 2 + (lit * 1e-4) ** 2) AS period_delta_err, verify_status AS period_verify_status, n_nights::VARCHAR || ' points' AS period_verify_note
  FROM (SELECT pe.*, o.period AS lit, row_number() OVER (PARTITION BY pe.obj_id ORDER BY computed_at DESC NULLS LAST, pe.n_nights DESC NULLS LAST, est_id DESC) AS r FROM pe JOIN obj o ON o.obj_id = pe.obj_id WHERE o.period IS NOT NULL) WHERE r = 1"""
INPUTS["am"] = """SELECT obj_id, avg(mag + zp::DOUBLE) AS mean_mag_app, CASE WHEN count(DISTINCT zp_source) = 1 THEN min(zp_source) ELSE 'mixed' END AS mag_zp_source FROM sn JOIN night USING (night_id) GROUP BY 1"""
INPUTS["lr"] = """SELECT obj_id, count(*) FILTER (WHERE status IN ('queued', 'running')) AS n_rerun_pending, arg_max(status, (requested_at, req_id)) AS last_rerun_status, max(requested_at) AS at FROM rr GROUP BY 1"""
INPUTS["se"] = """SELECT ob.* REPLACE (coalesce(n_transit_events, 0) AS n_transit_events), tm.p_match AS max_p_match, period_delta, period_delta_err, period_verify_status, period_verify_note, mean_mag_app, mag_zp_source,
  coalesce(n_rerun_pending, 0) AS n_rerun_pending, last_rerun_status, CASE WHEN last_rerun_status IN ('done', 'failed') THEN lr.at + INTERVAL 1 HOUR END AS last_rerun_finished_at,
  CASE WHEN duration_h IS NOT NULL THEN CASE WHEN duration_lower_limit THEN '≥ ' ELSE '' END || printf('%.2f h', duration_h) END AS duration_display
  FROM ob LEFT JOIN tm ON tm.obj_id = ob.obj_id LEFT JOIN pv ON pv.obj_id = ob.obj_id LEFT JOIN am ON am.obj_id = ob.obj_id LEFT JOIN lr ON lr.obj_id = ob.obj_id"""
_ROUNDED |= {"ra": 9, "dec": 9, "max_p_match": 6, "period_delta": 8, "period_delta_err": 9, "mean_mag_app": 5}
_SHORT = ("obj_id", "name")
_ON = {"p": "EXISTS (SELECT 1 FROM tm WHERE tm.obj_id = o.obj_id AND p_match >= 0.5)", "rerun": "o.n_rerun_pending > 0"}


def _short(name: str, where: str, f: Filters) -> None:
    @query(name, f"SELECT {', '.join(_SHORT)} FROM se o WHERE {where}")
    def _(t: Inputs) -> DataFrame:
        return matching(t, f, set(_SHORT)).select(*_SHORT)


_short("f17_f20_tristate_filters", "known AND class IN ('VAR', 'EXOP+VAR') AND mean_mag BETWEEN -10 AND -6", Filters(known=True, classes=("VAR", "EXOP+VAR"), mag_min=-10, mag_max=-6))
_short("w1_class", "class IN ('EXOP', 'VAR')", Filters(classes=("EXOP", "VAR")))
_short("w2_w3_flags", "is_exop AND NOT is_var", Filters(is_exop=True, is_var=False))
_short("w4_min_p_match", _ON["p"], Filters(min_p_match=0.5))
_short("w5_w6_known_source", "known AND source_db ILIKE '%nasa%'", Filters(known=True, source_db="nasa"))
_short("w7_w8_w9_status_review", "status = 'UNCONFIRMED' AND n_review_pending > 0 AND n_nights_reviewed = 0", Filters(status="UNCONFIRMED", needs_review=True, user_reviewed=False))
_short("w10_rerun_pending", _ON["rerun"], Filters(rerun_pending=True))
_short("w10_no_rerun_pending", "NOT " + _ON["rerun"], Filters(rerun_pending=False))
_short("w11_telescope", "EXISTS (SELECT 1 FROM sn JOIN night n USING (night_id) WHERE sn.obj_id = o.obj_id AND telescope = 'U60')", Filters(telescope="U60"))
_short("w12_w13_name_number", "name ILIKE '%j2%' AND gaia_id ILIKE '%73%'", Filters(name="J2", gaia_id="73"))
_short("w14_cone", """degrees(2 * asin(least(1, sqrt((cos(radians(dec)) * cos(radians(ra)) - cos(radians(60.75)) * cos(radians(331.58))) ** 2
  + (cos(radians(dec)) * sin(radians(ra)) - cos(radians(60.75)) * sin(radians(331.58))) ** 2 + (sin(radians(dec)) - sin(radians(60.75))) ** 2) / 2))) <= 1""", Filters(cone=(331.58, 60.75, 3600.0)))
_short("w15_w18_ranges", "mean_mag BETWEEN -10 AND -7 AND period BETWEEN 0.1 AND 3", Filters(mag_min=-10, mag_max=-7, period_min=0.1, period_max=3))
_short("w19_w20_w22_events", "best_snr >= 8 AND depth >= 0.005 AND n_nights >= 2", Filters(snr_min=8, depth_min=0.005, n_nights_min=2))
_short("w21_tier_max", "EXISTS (SELECT 1 FROM dt d WHERE d.obj_id = o.obj_id AND kind = 'transit' AND tier <= 1)", Filters(tier_max=1))
_short("w23_dates", "EXISTS (SELECT 1 FROM sn JOIN night n USING (night_id) WHERE sn.obj_id = o.obj_id AND night_date BETWEEN DATE '2007-01-03' AND DATE '2007-02-20')", Filters(night_from="2007-01-03", night_to="2007-02-20"))
_short("w24_periodogram", "NOT EXISTS (SELECT 1 FROM pg WHERE pg.obj_id = o.obj_id) AND known", Filters(has_periodogram=False, known=True))
_short("w25_kind_scope", "EXISTS (SELECT 1 FROM det d WHERE d.obj_id = o.obj_id AND kind IN ('bls', 'internight') AND mn_run_id IS NOT NULL)", Filters(detection_kinds=("bls", "internight"), detection_scope="multinight"))


@query("w26_w27_search", f"SELECT {rounded_sql((*COLUMNS, *DERIVED))}, duration_display FROM se")
def _(t: Inputs) -> DataFrame:
    """Every column of an answer, of every object."""
    return search(t).select(*rounded((*COLUMNS, *DERIVED)), "duration_display")


@query("w26_page", "SELECT obj_id, name, n_transit_events, round(best_snr, 4) AS best_snr FROM se ORDER BY se.best_snr DESC NULLS LAST, obj_id LIMIT 100 OFFSET 10")
def _(t: Inputs) -> DataFrame:
    return page(search(t), "best_snr", True, 100, 10).select("obj_id", "name", "n_transit_events", r6(c("best_snr"), "best_snr", 4))


def detail(t: Inputs, obj_id: int | None = None) -> dict[str, DataFrame]:
    """What an object's page shows, by part; of one object (the filter reaches the scans) or of all."""
    shapes = t.shape.filter("converged is not null")
    parts = {
        "detections": detections(t).filter("night_id is not null"), "multinight": detections(t).filter("mn_run_id is not null"), "nights": star_nights(t), "catalogues": catalogue_entries(t), "shapes": shapes,
        "matches": best_matches(t), "estimates": period_estimates(t), "periodograms": combined_peaks(t), "reviews": reviews(t), "requests": requests(t),
        "coincidences": chances(t).join(t.det.select("det_id", "obj_id"), "det_id"),
    }
    parts = {"object": search(t)} | parts
    return parts if obj_id is None else {n: df.filter(c("obj_id") == obj_id) for n, df in parts.items()}


@query("w29_object_detail", """
SELECT o.obj_id, (SELECT count(*) FROM dt d WHERE d.obj_id = o.obj_id AND night_id IS NOT NULL) AS detections, (SELECT count(*) FROM dt d WHERE d.obj_id = o.obj_id AND mn_run_id IS NOT NULL) AS multinight,
  (SELECT count(*) FROM sn WHERE sn.obj_id = o.obj_id) AS nights, (SELECT count(*) FROM cm WHERE cm.obj_id = o.obj_id) AS catalogues, (SELECT count(*) FROM shape s WHERE s.obj_id = o.obj_id AND converged IS NOT NULL) AS shapes,
  (SELECT count(*) FROM tm WHERE tm.obj_id = o.obj_id) AS matches, (SELECT count(*) FROM pe WHERE pe.obj_id = o.obj_id) AS estimates, (SELECT count(*) FROM pg WHERE pg.obj_id = o.obj_id) AS periodograms,
  (SELECT count(*) FROM rv WHERE rv.obj_id = o.obj_id) AS reviews, (SELECT count(*) FROM rr WHERE rr.obj_id = o.obj_id) AS requests, coalesce(k.n, 0) AS coincidences FROM obj o
  LEFT JOIN (SELECT obj_id, count(*) AS n FROM det WHERE night_id IS NOT NULL AND tc_bjd_tdb IS NOT NULL AND duration_h > 0 AND abs(depth) > 0 AND snr > 0 GROUP BY 1) k ON k.obj_id = o.obj_id""")
def _(t: Inputs) -> DataFrame:
    """How many rows each part of every object's page has."""
    out, parts = t.obj.select("obj_id"), {n: df for n, df in detail(t).items() if n != "object"}
    for name, rows in parts.items():
        out = out.join(rows.groupBy("obj_id").agg(F.count("*").alias(name)), "obj_id", "left")
    return out.select("obj_id", *(F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in parts))


@query("w28_ad_hoc_sql", "SELECT kind, count(*) AS n FROM det GROUP BY 1")
def _(t: Inputs) -> DataFrame:
    name = "detections_" + uuid.uuid4().hex
    t.det.createOrReplaceTempView(name)
    try:
        return run_sql(t.spark, f"SELECT kind, count(*) AS n FROM {name} GROUP BY kind -- by kind")[0]
    finally:
        t.spark.catalog.dropTempView(name)


@query("w30_light_curves", """
SELECT star_id AS obj_id, e.night_id, e.frame_index, file_name, round(bjd_tdb, 6) AS bjd_tdb, round(airmass, 5) AS airmass, round(zp::DOUBLE - 2.5 * log10(flux), 4) AS mag, round(1.085736204758 * fluxerr / flux, 5) AS mag_err
FROM ep e LEFT JOIN fr f ON f.night_id = e.night_id AND f.frame_index = e.frame_index LEFT JOIN night n ON n.night_id = e.night_id WHERE aper = 0""")
def _(t: Inputs) -> DataFrame:
    """Every epoch as its plot shows it; frames and nights that are missing leave nulls."""
    f = t.fr.select("night_id", "frame_index", "file_name", "bjd_tdb", "airmass")
    rows = t.ep.filter("aper = 0").join(f, ["night_id", "frame_index"], "left").join(t.night.select("night_id", "zp"), "night_id", "left")
    mag = c("zp").cast("double") + X.magnitude(c("flux"))
    return rows.select(c("star_id").alias("obj_id"), "night_id", "frame_index", "file_name", r6(c("bjd_tdb"), "bjd_tdb"), r6(c("airmass"), "airmass", 5), r6(mag, "mag", 4), r6(X.magnitude_error(c("flux"), c("fluxerr")), "mag_err", 5))


@query("w30_g31_combined", """
WITH k AS (SELECT night_id, star_id, median(flux) AS m FROM ep WHERE aper = 0 GROUP BY 1, 2), n AS (SELECT star_id FROM k GROUP BY 1 HAVING count(*) >= 2)
SELECT e.star_id AS obj_id, telescope || '/' || label AS label, e.frame_index, round(bjd_tdb, 6) AS bjd_tdb, round(flux / m, 6) AS y, round(fluxerr / m, 6) AS y_err
FROM ep e JOIN k ON k.night_id = e.night_id AND k.star_id = e.star_id JOIN n ON n.star_id = e.star_id JOIN fr f ON f.night_id = e.night_id AND f.frame_index = e.frame_index JOIN night g ON g.night_id = e.night_id WHERE aper = 0 AND bjd_tdb IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    """The epochs of all nights of every star seen on two or more, each night relative to its own median, with the night's label."""
    from lightloom.plans.series import combined

    rows = combined(t).join(t.night.select("night_id", F.concat("telescope", F.lit("/"), "label").alias("label")), "night_id")
    return rows.select(c("star_id").alias("obj_id"), "label", "frame_index", r6(c("t"), "bjd_tdb"), r6(c("y"), "y"), r6(c("e"), "y_err"))
