"""The results store: what is derived of every object from its nights, detections, reviews, catalogue entries and periods.

The tables at hand lack some columns of such a store.  Their stand-ins are computed here once, alike in both languages (see the
README): reviews of a night are the last saved review of each kind, catalogue entries are those of one name, period estimates and
peaks come from fitted shapes and multi-night detections, requests from saved reviews.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lightloom.functions import scalar as X
from lightloom.operators import robust as R
from lightloom.plans.registry import INPUTS, ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.relational import _COINC, _MATCH, chances, matching_shapes
from lightloom.plans.statistics import r6

c = F.col
#: The kinds of detection that speak for a planet and for a variable, and the multi-night kinds that count.
PLANET_KINDS, VARIABLE_KINDS, COUNTED_TOGETHER = ("transit", "bls"), ("variable", "internight", "ls_periodic", "recurrent"), ("recurrent",)
#: Catalogues of planets.
PLANET_CATALOGUES = ("NASA Exoplanet Archive", "TOI")
#: False-alarm probability and signal to noise from which a combined period counts.
FAP, BOX_SNR = 0.01, 7.0

_EX, _VA, _PC = (", ".join(f"'{k}'" for k in x) for x in (PLANET_KINDS, VARIABLE_KINDS, PLANET_CATALOGUES))

# ---- stand-ins -----------------------------------------------------------------------------------------------------------

INPUTS["rej"] = f"SELECT det_id FROM (WITH {_COINC} SELECT det_id FROM ch WHERE n_similar >= 3 AND p_chance < 1e-3)"
INPUTS["dt"] = """SELECT d.*, CASE WHEN flags = 'ON_VARIABLE' THEN 'user' ELSE 'search' END AS origin, CASE WHEN r.det_id IS NOT NULL THEN 'REJECTED' END AS auto_status,
  coalesce(regexp_matches(flags, '(^|[|])(EDGE|PARTIAL)([|]|$)'), false) AS low, CASE WHEN kind = 'variable' THEN snr / 1000 END AS amplitude, CASE WHEN kind = 'variable' THEN 0.02 + snr / 50 END AS period,
  CASE WHEN regexp_matches(flags, '(^|[|])PARTIAL([|]|$)') THEN 3 WHEN regexp_matches(flags, '(^|[|])(SHARED_EPOCH|APERTURE_INCONSISTENT|HIGH_BETA)([|]|$)') THEN 2 ELSE 1 END AS tier
  FROM det d LEFT JOIN rej r USING (det_id)"""
INPUTS["rv"] = f"""SELECT obj_id, night_id, arg_max(status, (saved_at, review_id)) FILTER (WHERE kind IN ({_EX}) AND status IN ('CONFIRMED', 'REJECTED')) AS exop_verdict,
  arg_max(status, (saved_at, review_id)) FILTER (WHERE kind IN ({_VA}) AND status IN ('CONFIRMED', 'REJECTED')) AS var_verdict, max(notes) AS note
  FROM detection_review_orphan WHERE obj_id IS NOT NULL AND night_id IS NOT NULL GROUP BY 1, 2"""
INPUTS["cm"] = f"""SELECT obj_id, CASE WHEN obj_class LIKE '%EXOP%' THEN CASE WHEN period IS NULL THEN 'TOI' ELSE 'NASA Exoplanet Archive' END ELSE 'Variables' END AS catalog, known_name AS name, known_type AS type, period, period * 1e-4 AS period_err
  FROM obj WHERE known AND known_name IS NOT NULL
  UNION ALL SELECT o.obj_id, s.catalog, s.designation, min(s.var_type), NULL, NULL FROM obj o JOIN catalog_source s ON s.designation = o.known_name GROUP BY 1, 2, 3"""
INPUTS["pe"] = """SELECT shape_id AS est_id, obj_id, t14_h * 5 / 24 AS period, tc_err AS period_err, n_points AS n_nights, depth AS fap, computed_at,
  CASE WHEN t14_lower_limit THEN 'long_period_needs_tie' WHEN converged THEN 'agrees' ELSE 'no_signal' END AS verify_status FROM shape"""
INPUTS["pg"] = """SELECT obj_id, CASE kind WHEN 'bls' THEN 'BLS' ELSE 'LS' END AS method, max(snr) AS depth_snr, 0.2 + max(snr) / 10 AS peak_period, 10 ** (-max(snr) / 10) AS fap
  FROM det WHERE kind IN ('bls', 'ls_periodic') AND mn_run_id IS NOT NULL AND snr IS NOT NULL GROUP BY ALL"""
INPUTS["sn"] = "SELECT star_id AS obj_id, night_id, -2.5 * log10(median(flux)) AS mag, count(*) AS n_epochs FROM ep WHERE aper = 0 GROUP BY 1, 2"
INPUTS["tm"] = f"SELECT obj_id, max(p_match) AS p_match FROM (WITH {_MATCH} SELECT obj_id, exp(-(zd ** 2 + zt ** 2) / 2) AS p_match FROM pr WHERE zd IS NOT NULL AND zt IS NOT NULL) GROUP BY 1"
INPUTS["rr"] = """SELECT DISTINCT review_id AS req_id, obj_id, CASE status WHEN 'CONFIRMED' THEN 'done' WHEN 'REJECTED' THEN 'failed' ELSE 'queued' END AS status, saved_at AS requested_at,
  CASE WHEN status IN ('CONFIRMED', 'REJECTED') THEN saved_at + INTERVAL 1 HOUR END AS finished_at FROM detection_review_orphan WHERE obj_id IS NOT NULL"""


def detections(t: Inputs) -> DataFrame:
    rejected = chances(t).filter("rejected").select("det_id", F.lit("REJECTED").alias("auto_status"))
    variable = c("kind") == "variable"
    tier = F.when(X.has_token(c("flags"), "PARTIAL"), 3).when(X.has_token(c("flags"), "SHARED_EPOCH", "APERTURE_INCONSISTENT", "HIGH_BETA"), 2).otherwise(1)
    return t.det.join(rejected, "det_id", "left").withColumns({
        "origin": F.when(c("flags") == "ON_VARIABLE", "user").otherwise("search"), "low": X.has_token(c("flags"), "EDGE", "PARTIAL"),
        "amplitude": F.when(variable, c("snr") / 1000), "period": F.when(variable, 0.02 + c("snr") / 50), "tier": tier,
    })


def reviews(t: Inputs) -> DataFrame:
    """The verdicts of a person on an object's night, the last saved of each sort."""
    rows = t.table("detection_review_orphan").filter("obj_id is not null and night_id is not null")
    decided = c("status").isin("CONFIRMED", "REJECTED")
    last = lambda kinds: F.max(F.when(c("kind").isin(*kinds) & decided, F.struct("saved_at", "review_id", "status")))["status"]
    return rows.groupBy("obj_id", "night_id").agg(last(PLANET_KINDS).alias("exop_verdict"), last(VARIABLE_KINDS).alias("var_verdict"), F.max("notes").alias("note"))


def catalogue_entries(t: Inputs) -> DataFrame:
    obj = t.obj
    own = obj.filter("known and known_name is not null").select(
        "obj_id", F.when(c("obj_class").contains("EXOP"), F.when(c("period").isNull(), "TOI").otherwise("NASA Exoplanet Archive")).otherwise("Variables").alias("catalog"),
        c("known_name").alias("name"), c("known_type").alias("type"), "period", (c("period") * 1e-4).alias("period_err"),
    )
    listed = t.table("catalog_source").select(c("designation").alias("name"), "catalog", "var_type").filter("name is not null")
    same = obj.select("obj_id", c("known_name").alias("name")).join(listed, "name").groupBy("obj_id", "catalog", "name").agg(F.min("var_type").alias("type"))
    return own.unionByName(same, allowMissingColumns=True)


def period_estimates(t: Inputs) -> DataFrame:
    status = F.when(c("t14_lower_limit"), "long_period_needs_tie").when(c("converged"), "agrees").otherwise("no_signal")
    return t.shape.select(
        c("shape_id").alias("est_id"), "obj_id", (c("t14_h") * 5 / 24).alias("period"), c("tc_err").alias("period_err"), c("n_points").alias("n_nights"), c("depth").alias("fap"),
        "computed_at", status.alias("verify_status"),
    )


def combined_peaks(t: Inputs) -> DataFrame:
    rows = t.det.filter("kind in ('bls', 'ls_periodic') and mn_run_id is not null and snr is not null")
    best = rows.groupBy("obj_id", F.when(c("kind") == "bls", "BLS").otherwise("LS").alias("method")).agg(F.max("snr").alias("depth_snr"))
    return best.withColumns({"peak_period": 0.2 + c("depth_snr") / 10, "fap": F.pow(F.lit(10.0), -c("depth_snr") / 10)})


def star_nights(t: Inputs) -> DataFrame:
    s = t.ep.filter("aper = 0").groupBy(c("star_id").alias("obj_id"), "night_id").agg(R.median("flux").alias("f"), F.count("*").alias("n_epochs"))
    return s.select("obj_id", "night_id", (-2.5 * F.log10("f")).alias("mag"), "n_epochs")


def best_matches(t: Inputs) -> DataFrame:
    """The best probability, by two degrees of freedom, of two shapes of an object being one."""
    p = matching_shapes(t).filter("zd is not null and zt is not null")
    return p.groupBy("obj_id").agg(F.exp(-F.min(c("zd") ** 2 + c("zt") ** 2) / 2).alias("p_match"))


def requests(t: Inputs) -> DataFrame:
    state = F.when(c("status") == "CONFIRMED", "done").when(c("status") == "REJECTED", "failed").otherwise("queued")
    done = F.when(c("status").isin("CONFIRMED", "REJECTED"), c("saved_at") + F.expr("INTERVAL 1 HOUR"))
    rows = t.table("detection_review_orphan").filter("obj_id is not null")
    return rows.select(c("review_id").alias("req_id"), "obj_id", state.alias("status"), c("saved_at").alias("requested_at"), done.alias("finished_at")).distinct()


# ---- flags of objects ----------------------------------------------------------------------------------------------------

#: Evidence by night, a person's verdict before it; then by object, with catalogues and what several nights show together.
INPUTS["fl"] = f"""
SELECT o.obj_id, coalesce(l.planet OR m.ex OR n.ex, false) AS is_exop, coalesce(l.other OR m.va OR n.va, false) AS is_var, coalesce(v.ex, false) AS exop_manual, coalesce(v.va, false) AS var_manual,
  coalesce(n.pending, 0) + coalesce(m.open_, 0) AS n_review_pending, coalesce(w.n, 0) AS n_nights_reviewed
FROM sky_object o
LEFT JOIN (SELECT obj_id, bool_or(CASE WHEN exop_verdict IS NOT NULL THEN exop_verdict = 'CONFIRMED' ELSE coalesce(ex, false) END) AS ex,
    bool_or(CASE WHEN var_verdict IS NOT NULL THEN var_verdict = 'CONFIRMED' ELSE coalesce(va, false) END) AS va,
    count(*) FILTER (WHERE (exop_verdict IS NULL AND coalesce(ex_open, false)) OR (var_verdict IS NULL AND coalesce(va_open, false))) AS pending
  FROM (SELECT obj_id, night_id, bool_or(kind IN ({_EX})) AS ex, bool_or(kind IN ({_VA})) AS va, bool_or(kind IN ({_EX}) AND coalesce(status, 'UNCONFIRMED') = 'UNCONFIRMED') AS ex_open,
      bool_or(kind IN ({_VA}) AND coalesce(status, 'UNCONFIRMED') = 'UNCONFIRMED') AS va_open
    FROM dt WHERE night_id IS NOT NULL AND origin = 'search' AND coalesce(status, '') <> 'REJECTED' AND (coalesce(auto_status, '') <> 'REJECTED' OR coalesce(status, '') = 'CONFIRMED') GROUP BY 1, 2) e
  FULL JOIN rv USING (obj_id, night_id) GROUP BY 1) n ON n.obj_id = o.obj_id
LEFT JOIN (SELECT obj_id, bool_or(kind IN ({_EX})) AS ex, bool_or(kind IN ({_VA})) AS va, count(*) FILTER (WHERE coalesce(status, 'UNCONFIRMED') = 'UNCONFIRMED') AS open_
  FROM dt WHERE mn_run_id IS NOT NULL AND origin = 'search' AND coalesce(status, '') <> 'REJECTED' AND kind IN ('recurrent') GROUP BY 1) m ON m.obj_id = o.obj_id
LEFT JOIN (SELECT obj_id, bool_or(catalog IN ({_PC})) AS planet, bool_or(catalog NOT IN ({_PC})) AS other FROM cm GROUP BY 1) l ON l.obj_id = o.obj_id
LEFT JOIN (SELECT obj_id, bool_or(exop_verdict IS NOT NULL) AS ex, bool_or(var_verdict IS NOT NULL) AS va FROM rv GROUP BY 1) v ON v.obj_id = o.obj_id
LEFT JOIN (SELECT obj_id, count(*) AS n FROM (SELECT obj_id, night_id FROM rv WHERE coalesce(exop_verdict, var_verdict, note) IS NOT NULL
  UNION SELECT obj_id, night_id FROM dt WHERE night_id IS NOT NULL AND origin = 'search' AND status IN ('CONFIRMED', 'REJECTED')) GROUP BY 1) w ON w.obj_id = o.obj_id"""


def night_states(t: Inputs, det: DataFrame, rev: DataFrame) -> DataFrame:
    """(obj_id, night_id, exop_on, var_on, pending): what a night says of an object; a verdict overrides its own night only."""
    status = F.coalesce("status", F.lit("UNCONFIRMED"))
    counts = c("night_id").isNotNull() & (c("origin") == "search") & (status != "REJECTED") & (c("auto_status").isNull() | (status == "CONFIRMED"))
    sorts = {"exop": PLANET_KINDS, "var": VARIABLE_KINDS}
    seen = [F.bool_or(c("kind").isin(*kinds)).alias(f"{s}_ev") for s, kinds in sorts.items()]
    open_ = [F.bool_or(c("kind").isin(*kinds) & (status == "UNCONFIRMED")).alias(f"{s}_open") for s, kinds in sorts.items()]
    nights = det.filter(counts).groupBy("obj_id", "night_id").agg(*seen, *open_).join(rev, ["obj_id", "night_id"], "full")
    no = F.lit(False)
    on = [F.when(c(f"{s}_verdict").isNotNull(), c(f"{s}_verdict") == "CONFIRMED").otherwise(F.coalesce(f"{s}_ev", no)).alias(f"{s}_on") for s in sorts]
    waits = [c(f"{s}_verdict").isNull() & F.coalesce(f"{s}_open", no) for s in sorts]
    return nights.select("obj_id", "night_id", *on, (waits[0] | waits[1]).alias("pending"))


def flags(t: Inputs) -> DataFrame:
    """Every object's flags from evidence of its nights, of runs over several nights and of catalogues, and what waits for review."""
    det, rev, status = detections(t), reviews(t), F.coalesce("status", F.lit("UNCONFIRMED"))
    search = det.filter("origin = 'search'")
    night = night_states(t, det, rev).groupBy("obj_id").agg(F.bool_or("exop_on").alias("ex_n"), F.bool_or("var_on").alias("va_n"), F.count_if("pending").alias("pending"))
    person = rev.groupBy("obj_id").agg(F.bool_or(c("exop_verdict").isNotNull()).alias("ex_p"), F.bool_or(c("var_verdict").isNotNull()).alias("va_p"))
    said = rev.filter(F.coalesce("exop_verdict", "var_verdict", "note").isNotNull()).select("obj_id", "night_id")
    judged = search.filter("night_id is not null and status in ('CONFIRMED', 'REJECTED')").select("obj_id", "night_id")
    reviewed = said.unionByName(judged).distinct().groupBy("obj_id").agg(F.count("*").alias("reviewed"))
    runs = search.filter(c("mn_run_id").isNotNull() & (status != "REJECTED") & c("kind").isin(*COUNTED_TOGETHER))
    runs = runs.groupBy("obj_id").agg(F.bool_or(c("kind").isin(*PLANET_KINDS)).alias("ex_m"), F.bool_or(c("kind").isin(*VARIABLE_KINDS)).alias("va_m"), F.count_if(status == "UNCONFIRMED").alias("open"))
    planet = c("catalog").isin(*PLANET_CATALOGUES)
    books = catalogue_entries(t).groupBy("obj_id").agg(F.bool_or(planet).alias("ex_l"), F.bool_or(~planet).alias("va_l"))
    out = t.obj.select("obj_id")
    for part in (night, person, reviewed, runs, books):
        out = out.join(part, "obj_id", "left")
    any_of = lambda *names: F.coalesce(F.greatest(*names), F.lit(False))
    zero = F.lit(0).cast("long")
    return out.select(
        "obj_id", any_of("ex_l", "ex_m", "ex_n").alias("is_exop"), any_of("va_l", "va_m", "va_n").alias("is_var"), F.coalesce("ex_p", F.lit(False)).alias("exop_manual"),
        F.coalesce("va_p", F.lit(False)).alias("var_manual"), (F.coalesce("pending", zero) + F.coalesce("open", zero)).alias("n_review_pending"), F.coalesce("reviewed", zero).alias("n_nights_reviewed"),
    )


def class_of(exop: Column, var: Column) -> Column:
    return F.when(exop & var, "EXOP+VAR").when(exop, "EXOP").when(var, "VAR").otherwise("UNC")


@query("d1_refresh_flags", """
SELECT obj_id, is_exop, is_var, CASE WHEN is_exop AND is_var THEN 'EXOP+VAR' WHEN is_exop THEN 'EXOP' WHEN is_var THEN 'VAR' ELSE 'UNC' END AS class, CASE WHEN exop_manual THEN 'manual' ELSE 'auto' END AS exop_source,
  CASE WHEN var_manual THEN 'manual' ELSE 'auto' END AS var_source, CASE WHEN exop_manual OR var_manual THEN 'manual' ELSE 'auto' END AS class_source, n_review_pending, n_nights_reviewed FROM fl""")
def _(t: Inputs) -> DataFrame:
    said = lambda x: F.when(x, "manual").otherwise("auto")
    ex, va = c("exop_manual"), c("var_manual")
    return flags(t).select(
        "obj_id", "is_exop", "is_var", class_of(c("is_exop"), c("is_var")).alias("class"), said(ex).alias("exop_source"), said(va).alias("var_source"), said(ex | va).alias("class_source"),
        "n_review_pending", "n_nights_reviewed",
    )


@query("x10_x11_effective_status", """
SELECT det_id, CASE WHEN coalesce(status, 'UNCONFIRMED') = 'UNCONFIRMED' AND auto_status = 'REJECTED' THEN 'REJECTED (auto)' ELSE coalesce(status, 'UNCONFIRMED') END AS effective FROM dt""")
def _(t: Inputs) -> DataFrame:
    """A person's verdict stands; else what the check of coincidences says."""
    status = F.coalesce("status", F.lit("UNCONFIRMED"))
    return detections(t).select("det_id", F.when((status == "UNCONFIRMED") & c("auto_status").isNotNull(), "REJECTED (auto)").otherwise(status).alias("effective"))


@query("x11_night_states", f"""
WITH e AS (SELECT obj_id, night_id, kind IN ({_EX}) AS ex, kind IN ({_VA}) AS va, coalesce(status, 'UNCONFIRMED') AS st FROM dt
  WHERE night_id IS NOT NULL AND origin = 'search' AND coalesce(status, '') <> 'REJECTED' AND (auto_status IS NULL OR coalesce(status, '') = 'CONFIRMED')),
k AS (SELECT obj_id, night_id FROM e UNION SELECT obj_id, night_id FROM rv)
SELECT k.obj_id, k.night_id, coalesce(exop_verdict = 'CONFIRMED', EXISTS (SELECT 1 FROM e WHERE e.obj_id = k.obj_id AND e.night_id = k.night_id AND ex)) AS exop_on,
  coalesce(var_verdict = 'CONFIRMED', EXISTS (SELECT 1 FROM e WHERE e.obj_id = k.obj_id AND e.night_id = k.night_id AND va)) AS var_on,
  EXISTS (SELECT 1 FROM e WHERE e.obj_id = k.obj_id AND e.night_id = k.night_id AND st = 'UNCONFIRMED' AND ((ex AND exop_verdict IS NULL) OR (va AND var_verdict IS NULL))) AS pending
FROM k LEFT JOIN rv ON rv.obj_id = k.obj_id AND rv.night_id = k.night_id""")
def _(t: Inputs) -> DataFrame:
    return night_states(t, detections(t), reviews(t))


# ---- the object row ------------------------------------------------------------------------------------------------------

INPUTS["ob"] = f"""
SELECT o.obj_id, o.name, o.ra, o.dec, o.gaia_id, o.status, f.is_exop, f.is_var, CASE WHEN f.is_exop AND f.is_var THEN 'EXOP+VAR' WHEN f.is_exop THEN 'EXOP' WHEN f.is_var THEN 'VAR' ELSE 'UNC' END AS class,
  f.n_review_pending, f.n_nights_reviewed, coalesce(s.n, 0) AS n_nights, s.mag AS mean_mag, s.a AS first_night, s.b AS last_night, coalesce(d.n, 0) AS n_detections, d.n_transit AS n_transit_events, b.snr AS best_snr, b.depth, b.duration_h,
  b.low AS duration_lower_limit, d.amplitude, k.obj_id IS NOT NULL AS known, k.source_db, coalesce(k.p_name, k.v_name) AS known_name, k.v_type AS known_type, coalesce(k.p_period, k.v_period) AS known_period,
  CASE WHEN man THEN o.period ELSE coalesce(k.p_period, k.v_period, CASE WHEN e.fap <= {FAP} THEN e.period END, CASE WHEN f.is_exop AND bl.depth_snr >= {BOX_SNR} THEN bl.peak_period END, CASE WHEN f.is_var AND ls.fap <= {FAP} THEN ls.peak_period END, d.p50) END AS period,
  CASE WHEN man THEN 'manual' WHEN coalesce(k.p_period, k.v_period) IS NOT NULL THEN 'catalog' WHEN e.fap <= {FAP} THEN 'LS' WHEN f.is_exop AND bl.depth_snr >= {BOX_SNR} THEN 'BLS' WHEN f.is_var AND ls.fap <= {FAP} THEN 'LS' WHEN d.p50 IS NOT NULL THEN 'night-LS' END AS period_source,
  CASE WHEN man THEN NULL WHEN k.p_period IS NOT NULL THEN k.p_err WHEN k.v_period IS NOT NULL THEN k.v_err WHEN e.fap <= {FAP} THEN e.period_err END AS period_err,
  CASE WHEN NOT man AND coalesce(k.p_period, k.v_period) IS NULL AND e.fap <= {FAP} THEN e.n_nights END AS period_n_nights
FROM (SELECT *, coalesce(status = 'CONFIRMED' AND period IS NOT NULL, false) AS man FROM obj) o JOIN fl f ON f.obj_id = o.obj_id
LEFT JOIN (SELECT obj_id, count(*) AS n, avg(mag) AS mag, min(night_date) AS a, max(night_date) AS b FROM sn LEFT JOIN night USING (night_id) GROUP BY 1) s ON s.obj_id = o.obj_id
LEFT JOIN (SELECT obj_id, count(*) AS n, count(*) FILTER (WHERE kind = 'transit') AS n_transit, max(amplitude) AS amplitude, quantile_cont(period, 0.5) AS p50 FROM dt GROUP BY 1) d ON d.obj_id = o.obj_id
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY snr DESC, det_id) AS r FROM dt WHERE kind = 'transit' AND snr IS NOT NULL AND origin = 'search' AND (auto_status IS NULL OR status = 'CONFIRMED')) b ON b.obj_id = o.obj_id AND b.r = 1
LEFT JOIN (SELECT obj_id, string_agg(DISTINCT catalog, ', ' ORDER BY catalog) AS source_db, max(name) FILTER (WHERE rp = 1) AS p_name, max(period) FILTER (WHERE rp = 1) AS p_period, max(period_err) FILTER (WHERE rp = 1) AS p_err,
    max(name) FILTER (WHERE rv = 1) AS v_name, max(type) FILTER (WHERE rv = 1) AS v_type, max(period) FILTER (WHERE rv = 1) AS v_period, max(period_err) FILTER (WHERE rv = 1) AS v_err
  FROM (SELECT *, CASE WHEN catalog IN ({_PC}) THEN row_number() OVER (PARTITION BY obj_id, catalog IN ({_PC}) ORDER BY catalog, name) END AS rp,
    CASE WHEN catalog NOT IN ({_PC}) THEN row_number() OVER (PARTITION BY obj_id, catalog IN ({_PC}) ORDER BY type IS NULL, catalog, name) END AS rv FROM cm) GROUP BY 1) k ON k.obj_id = o.obj_id
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY obj_id ORDER BY n_nights DESC NULLS LAST, computed_at DESC NULLS LAST, est_id DESC) AS r FROM pe WHERE period IS NOT NULL AND verify_status <> 'long_period_needs_tie') e ON e.obj_id = o.obj_id AND e.r = 1
LEFT JOIN pg bl ON bl.obj_id = o.obj_id AND bl.method = 'BLS' LEFT JOIN pg ls ON ls.obj_id = o.obj_id AND ls.method = 'LS'"""


#: The columns that come with each part of an object; a period needs several.
_PERIOD = {"period", "period_source"}
_PARTS = {
    "flags": {"is_exop", "is_var", "class", "n_review_pending", "n_nights_reviewed"} | _PERIOD, "seen": {"n_nights", "mean_mag", "first_night", "last_night"}, "counted": {"n_detections", "n_transit_events", "amplitude"} | _PERIOD,
    "best": {"best_snr", "depth", "duration_h", "duration_lower_limit"}, "books": {"known", "source_db", "known_name", "known_type", "known_period", "period_err", "period_n_nights"} | _PERIOD,
    "estimate": {"period_err", "period_n_nights"} | _PERIOD, "peaks": _PERIOD,
}


def objects(t: Inputs, wanted: set[str] | None = None) -> DataFrame:
    """Every object with all that is derived of it, or with the wanted columns only: what these do not need is not computed.

    Each part is one aggregate by object, so all of them and the joins after share one partitioning.  The period is the first
    that there is: a person's, a catalogue's (planets first), the estimate's if significant, a combined box or sine
    period where the flags agree with it, the median of single nights.
    """
    det = detections(t)
    planet = c("catalog").isin(*PLANET_CATALOGUES)

    def seen() -> DataFrame:
        of_nights = star_nights(t).join(t.night.select("night_id", "night_date"), "night_id", "left")
        return of_nights.groupBy("obj_id").agg(F.count("*").alias("n_nights_"), F.avg("mag").alias("mean_mag"), F.min("night_date").alias("first_night"), F.max("night_date").alias("last_night"))

    def counted() -> DataFrame:
        return t.det.withColumn("variable", c("kind") == "variable").groupBy("obj_id").agg(
            F.count("*").alias("n_det"), F.count_if(c("kind") == "transit").alias("n_transit_events"), F.max(F.when(c("variable"), c("snr") / 1000)).alias("amplitude"),
            R.median(F.when(c("variable"), 0.02 + c("snr") / 50)).alias("p_night"),
        )

    def best() -> DataFrame:
        usable = "kind = 'transit' and snr is not null and origin = 'search' and (auto_status is null or coalesce(status, '') = 'CONFIRMED')"
        rows = det.filter(usable).groupBy("obj_id").agg(F.max(F.struct("snr", (-c("det_id")).alias("k"), "depth", "duration_h", "low")).alias("b"))
        return rows.select("obj_id", c("b.snr").alias("best_snr"), "b.depth", "b.duration_h", c("b.low").alias("duration_lower_limit"))

    def books() -> DataFrame:
        first = lambda on, *order: F.min(F.when(on, F.struct(*order, "type", "period", "period_err")))
        return catalogue_entries(t).groupBy("obj_id").agg(
            F.array_join(F.sort_array(F.collect_set("catalog")), ", ").alias("source_db"), first(planet, "catalog", "name").alias("pl"), first(~planet, c("type").isNull().alias("none"), "catalog", "name").alias("va")
        )

    def estimate() -> DataFrame:
        good = period_estimates(t).filter("period is not null and verify_status <> 'long_period_needs_tie'")
        return good.groupBy("obj_id").agg(F.max(F.struct("n_nights", "computed_at", "est_id", "period", "period_err", "fap")).alias("e"))

    def peaks() -> DataFrame:
        return combined_peaks(t).groupBy("obj_id").agg(*(F.max(F.when(c("method") == m, F.struct("depth_snr", "peak_period", "fap"))).alias(m) for m in ("BLS", "LS")))

    out = t.obj.select("obj_id", "name", "ra", "dec", "gaia_id", "status", c("period").alias("own"))
    for name, part in {"flags": lambda: flags(t), "seen": seen, "counted": counted, "best": best, "books": books, "estimate": estimate, "peaks": peaks}.items():
        if wanted is None or _PARTS[name] & wanted:
            out = out.join(part(), "obj_id", "left")
    zero = F.lit(0).cast("long")
    shown = {n: (lambda n=n: c(n)) for n in ("obj_id", "name", "ra", "dec", "gaia_id", "status", "is_exop", "is_var", "n_review_pending", "n_nights_reviewed", "mean_mag", "first_night", "last_night",
                                             "n_transit_events", "best_snr", "depth", "duration_h", "duration_lower_limit", "amplitude", "source_db")}
    manual = lambda: F.coalesce((c("status") == "CONFIRMED") & c("own").isNotNull(), F.lit(False))
    listed = lambda: F.coalesce("pl.period", "va.period")
    sure = lambda: F.coalesce(c("e.fap") <= FAP, F.lit(False))
    box = lambda: c("is_exop") & F.coalesce(c("BLS.depth_snr") >= BOX_SNR, F.lit(False))
    sine = lambda: c("is_var") & F.coalesce(c("LS.fap") <= FAP, F.lit(False))
    found = lambda: F.coalesce(listed(), F.when(sure(), c("e.period")), F.when(box(), c("BLS.peak_period")), F.when(sine(), c("LS.peak_period")), c("p_night"))
    source = lambda: F.when(manual(), "manual").when(listed().isNotNull(), "catalog").when(sure(), "LS").when(box(), "BLS").when(sine(), "LS").when(c("p_night").isNotNull(), "night-LS")
    error = lambda: F.when(manual(), None).when(c("pl.period").isNotNull(), c("pl.period_err")).when(c("va.period").isNotNull(), c("va.period_err")).when(sure(), c("e.period_err"))
    shown |= {
        "class": lambda: class_of(c("is_exop"), c("is_var")), "n_nights": lambda: F.coalesce("n_nights_", zero), "n_detections": lambda: F.coalesce("n_det", zero), "known": lambda: c("source_db").isNotNull(),
        "known_name": lambda: F.coalesce("pl.name", "va.name"), "known_type": lambda: c("va.type"), "known_period": listed, "period": lambda: F.when(manual(), c("own")).otherwise(found()), "period_source": source,
        "period_err": error, "period_n_nights": lambda: F.when(~manual() & listed().isNull() & sure(), c("e.n_nights")),
    }
    always = {"obj_id", "name", "ra", "dec", "gaia_id", "status"}
    return out.select(*(x().alias(n) for n, x in shown.items() if wanted is None or n in wanted | always))


_ROUNDED = {"mean_mag": 5, "best_snr": 4, "depth": 6, "duration_h": 4, "amplitude": 6, "known_period": 8, "period": 8, "period_err": 9}
_OBJECT = ("obj_id", "n_nights", "mean_mag", "first_night", "last_night", "n_detections", "best_snr", "depth", "duration_h", "duration_lower_limit", "amplitude", "known", "source_db", "known_name", "known_type",
           "known_period", "period", "period_source", "period_err", "period_n_nights")


def rounded_sql(names: tuple[str, ...]) -> str:
    return ", ".join(f"round({n}, {_ROUNDED[n]}) AS {n}" if n in _ROUNDED else n for n in names)


def rounded(names: tuple[str, ...]) -> list[Column]:
    return [r6(c(n), n, _ROUNDED[n]) if n in _ROUNDED else c(n) for n in names]


@query("d2_refresh_objects", f"SELECT {rounded_sql(_OBJECT)} FROM ob")
def _(t: Inputs) -> DataFrame:
    return objects(t).select(*rounded(_OBJECT))


# ---- changes of the layout -----------------------------------------------------------------------------------------------

@query("k10_backfills", r"""
SELECT det_id, coalesce(regexp_matches(flags, '(^|[|])(EDGE|PARTIAL)([|]|$)'), false) AS duration_lower_limit, coalesce(status, 'UNCONFIRMED') AS status, CASE WHEN night_id IS NULL THEN 'multinight' ELSE 'night' END AS scope FROM det""")
def _(t: Inputs) -> DataFrame:
    """The columns that a new version of the detections' layout fills from old ones."""
    return t.det.select(
        "det_id", X.has_token(c("flags"), "EDGE", "PARTIAL").alias("duration_lower_limit"), F.coalesce("status", F.lit("UNCONFIRMED")).alias("status"),
        F.when(c("night_id").isNull(), "multinight").otherwise("night").alias("scope"),
    )


@query("k10_flags_of_classes", """
SELECT obj_id, coalesce(obj_class LIKE '%EXOP%', false) AS is_exop, coalesce(obj_class LIKE '%VAR%', false) AS is_var FROM sky_object""")
def _(t: Inputs) -> DataFrame:
    """Flags that an older layout kept only as a class."""
    has = lambda word: F.coalesce(c("obj_class").contains(word), F.lit(False))
    return t.table("sky_object").select("obj_id", has("EXOP").alias("is_exop"), has("VAR").alias("is_var"))


def latest(df: DataFrame, by: str, *order: str) -> DataFrame:
    """The last row of each key, missing values first."""
    w = Window.partitionBy(by).orderBy(*(F.desc_nulls_last(o) for o in order))
    return df.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")
