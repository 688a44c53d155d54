"""Queries of the kernels over whole series, as grouped Arrow functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lightloom.functions import kernels as G
from lightloom.functions import scalar as X
from lightloom.operators import robust as R
from lightloom.plans.more import _tied, tie
from lightloom.plans.registry import ORACLE, QUERIES, Inputs, query  # noqa: F401
from lightloom.plans.statistics import normalised, r6

c = F.col
#: Epochs of a star within so many days are averaged: a twentieth of the shortest period that is looked for.
BIN = 0.001
#: Nights and epochs that a star must have for a period.
NIGHTS, EPOCHS = 2, 20


#: Columns of one series, by name.
Rows = dict[str, np.ndarray]


def per_series(df: DataFrame, key: list[str], run: Callable, schema: str, order: str = "t", together: bool = False) -> DataFrame:
    """One row per group for which ``run`` (of the rows in order; ``together``: of a list of groups, with a list of results) gives a result.  Groups are single series of a night, or a
    star's epochs averaged within ``BIN``, so their size is bounded by time and not by the number of rows.

    Groups lie side by side in batches of many, as one a batch would cost more than most kernels do.
    """
    types = dict(df.dtypes)
    ddl = ", ".join(f"{k} {types[k]}" for k in key) + ", " + schema
    fields = list(to_arrow_schema(StructType.fromDDL(ddl)))

    def done(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        columns = {n: t[n].to_numpy() for n in t.column_names}
        series = [{n: v[i:j] for n, v in columns.items()} for i, j in zip(starts[:-1], starts[1:])]
        found = run(series) if together else [run(one) for one in series]
        rows = [{k: one[k][0] for k in key} | got for one, got in zip(series, found) if got is not None]
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type, from_pandas=True) for f in fields], names=[f.name for f in fields])

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # the last group's rows may go on in the next batch
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            ids = [t[k].to_numpy() for k in key]
            cuts = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in ids])) + 1
            if held and last != tuple(v[0] for v in ids):
                cuts = np.concatenate([[0], cuts])
            if len(cuts):
                begun = pa.concat_tables([*held, t.slice(0, int(cuts[-1]))])
                before = sum(x.num_rows for x in held)
                yield done(begun, np.unique(np.concatenate([[0], before + cuts])))
                held = [t.slice(int(cuts[-1]))]
            else:
                held.append(t)
            last = tuple(v[-1] for v in ids)
        if held:
            rest = pa.concat_tables(held)
            yield done(rest, np.array([0, rest.num_rows]))

    # By a hash of the key: an exchange by the key itself would be dropped after a join by it, which may split its partitions.
    return df.repartition(F.xxhash64(*key)).sortWithinPartitions(*key, order).mapInArrow(grouped, ddl)


def good_frames(t: Inputs) -> DataFrame:
    return t.fr.filter("bjd_tdb is not null and kept").select("night_id", "frame_index", c("bjd_tdb").alias("t"))


def night_series(t: Inputs) -> DataFrame:
    """(night_id, star_id, aper, t, y, e): normalised flux against time, of good frames."""
    x = normalised(t).select("night_id", "star_id", "aper", "frame_index", c("x").alias("y"), c("s").alias("e"))
    return x.join(good_frames(t), ["night_id", "frame_index"]).select("night_id", "star_id", "aper", "t", "y", "e")


def combined(t: Inputs) -> DataFrame:
    """(star_id, night_id, frame_index, t, y, e): all epochs of stars seen on several nights, relative to their median of the night.

    Epochs move once to their frames and once to their stars.  Frames come as lists of times, empty for those without one, as
    medians and nights count all epochs.
    """
    frame = ["night_id", "frame_index"]
    times = t.fr.groupBy(*frame).agg(F.collect_list("bjd_tdb").alias("ts"))
    one = t.epochs(t.table("matched_epoch").filter("aper = 0 and star_id is not null").repartition(*frame))
    x = one.join(times, frame, "left").repartition("star_id")
    star, night = Window.partitionBy("star_id"), Window.partitionBy("star_id", "night_id")
    x = x.withColumn("k", F.row_number().over(night.orderBy("frame_index"))).withColumn("m", R.median("flux").over(night))
    x = x.withColumn("n", F.count(F.when(c("k") == 1, 1)).over(star)).filter(f"n >= {NIGHTS}")
    return x.select("star_id", "night_id", "frame_index", F.explode("ts").alias("t"), (c("flux") / c("m")).alias("y"), (c("fluxerr") / c("m")).alias("e"))


def long_series(t: Inputs, epochs: DataFrame | None = None) -> DataFrame:
    """``combined``, or other epochs, with the epochs of each star and night averaged within ``BIN``, of stars that have epochs enough."""
    w = 1 / c("e") ** 2
    mean = lambda x: F.sum(w * c(x)) / F.sum(w)
    out = (combined(t) if epochs is None else epochs).groupBy("star_id", "night_id", F.floor(c("t") / BIN).alias("b")).agg(mean("t").alias("t"), mean("y").alias("y"), (1 / F.sqrt(F.sum(w))).alias("e"))
    return out.withColumn("n", F.count("*").over(Window.partitionBy("star_id"))).filter(f"n >= {EPOCHS}").drop("b", "n")


def tied(t: Inputs) -> DataFrame:
    """(star_id, night_id, frame_index, t, y, e): epochs in magnitudes on the scale that ties the nights, of stars seen on several.

    An epoch's own error and that of its night's mean add up.
    """
    k, z = tie(t)
    frames = t.fr.filter("bjd_tdb is not null").select("night_id", "frame_index", c("bjd_tdb").alias("t"))
    x = t.ep.filter("aper = 0").join(k, ["night_id", "star_id"]).join(z, "night_id").join(frames, ["night_id", "frame_index"])
    error = F.hypot(2.5 / np.log(10) * c("fluxerr") / c("flux"), F.sqrt("v"))
    return x.select("star_id", "night_id", "frame_index", "t", (c("m") - c("z") - 2.5 * F.log10(c("flux") / c("med"))).alias("y"), error.alias("e"))


def _arrays(rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(rows[k].astype(float) for k in "tye")  # type: ignore[return-value]


_BOX = "aper int, snr double, depth double, tc double, duration_h double, n_in int, coverage double, beta double, gain double, depths array<double>, errors array<double>, flags string"


def dips(t: Inputs) -> DataFrame:
    """The best dip of every star and night, in the aperture of least scatter, with its depth in the other apertures at the same time.

    Apertures that disagree by more than three deviations are flagged.
    """

    def run(rows: Rows) -> dict | None:
        aper, every = rows["aper"], _arrays(rows)
        parts = {int(a): tuple(v[aper == a] for v in every) for a in np.unique(aper)}
        spread = {a: np.median(np.abs(y - np.median(y))) for a, (_, y, _) in parts.items()}
        best = min(parts, key=lambda a: (spread[a], a))
        got = G.box_search(*parts[best])
        if got is None:
            return None
        depth, error = zip(*((got["depth"], got["error"]) if a == best else G.box_depth(*parts[a], got["tc"], got["duration_h"]) for a in sorted(parts)))
        told = [(d, s) for d, s in zip(depth, error) if np.isfinite(d) and np.isfinite(s) and s > 0]
        chi2 = sum(((d - got["depth"]) / s) ** 2 for d, s in told)
        flags = [got["flags"], "APERTURE_INCONSISTENT" if len(told) >= 2 and chi2 / (len(told) - 1) > 9 else ""]
        return got | {"aper": best, "depths": list(depth), "errors": list(error), "flags": "|".join(x for x in flags if x)}

    return per_series(night_series(t), ["night_id", "star_id"], run, _BOX)


@query("g1_g2_g3_g4_box_search")
def box_search(t: Inputs) -> DataFrame:
    """Dips with what they share with other stars of their night, their class, and whether they are candidates."""
    found = dips(t)
    strong = found.filter("snr >= 5").select("night_id", "star_id", c("tc").alias("t"), (c("duration_h") / 48).alias("h"))
    pool = strong.groupBy("night_id").agg(F.count("*").alias("pool"))
    near = R.counts_within(strong, "night_id", "star_id", "t", "h").withColumnRenamed("n", "n_near")
    out = found.join(near, ["night_id", "star_id"], "left").join(pool, "night_id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
    shared = (c("pool") >= 2) & (c("n_near") >= 2) & (c("n_near") / (c("pool") - 1) >= 0.3)
    out = out.withColumn("flags", F.when(F.coalesce(shared, F.lit(False)), F.concat_ws("|", F.when(c("flags") != "", c("flags")), F.lit("SHARED_EPOCH"))).otherwise(c("flags")))
    bits = X.flag_bits(c("flags"))
    candidate = (c("snr") >= 6) & ~X.has_token(c("flags"), "STEP_LIKE", "TOO_DEEP", "FEW_POINTS")
    return out.drop("pool").withColumns({"tier": X.tier(bits), "candidate": candidate})


@query("g5_common_trends")
def _(t: Inputs) -> DataFrame:
    """Common trends of each night: the eigenvectors of the sum, over all its stars, of each star's products of frames.

    Sums of stars add up, so a night may have any number of them; what meets is a matrix of frames.
    """
    x = normalised(t).filter("aper = 0").groupBy("night_id", "star_id").agg(F.collect_list(F.struct("frame_index", "x")).alias("r"))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for night, stars in batch.groupby("night_id"):
                series = [{p["frame_index"]: p["x"] for p in r} for r in stars["r"]]
                frames = sorted(set().union(*series))
                place = {f: k for k, f in enumerate(frames)}
                z = np.zeros((len(series), len(frames)))
                for row, s in zip(z, series):
                    row[[place[f] for f in s]] = G.standard(np.array(list(s.values()), float))
                yield pd.DataFrame({"night_id": [night], "n": [len(series)], "frames": [frames], "gram": [(z.T @ z).ravel()]})

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        frames = sorted({f for fs in rows["frames"] for f in fs})
        place, gram = {f: k for k, f in enumerate(frames)}, np.zeros((len(frames), len(frames)))
        for fs, g in zip(rows["frames"], rows["gram"]):
            at = [place[f] for f in fs]
            gram[np.ix_(at, at)] += np.asarray(g).reshape(len(at), len(at))
        if min(len(frames), int(rows["n"].sum())) < 4:
            return pd.DataFrame({n: pd.Series([], dtype=object) for n in ("night_id", "k", "share", "frames", "trend")})
        v, share = G.principal(gram)
        return pd.DataFrame([{"night_id": rows["night_id"].iloc[0], "k": k, "share": float(share[k]), "frames": frames, "trend": v[k].tolist()} for k in range(len(v))])

    sums = x.mapInPandas(partial, "night_id int, n long, frames array<int>, gram array<double>")
    return sums.groupBy("night_id").applyInPandas(merged, "night_id int, k int, share double, frames array<int>, trend array<double>")


_VARIABLE = "n long, rms_robust double, rms_std double, chi2 double, eta double, eta_significance double, slope double, slope_significance double, eclipse_share double, ls_period double, ls_power double, ls_fap double, class string"


@query("g6_g7_night_periods")
def _(t: Inputs) -> DataFrame:
    """How every star varies within a night: scatter, smoothness, slope, eclipses, period; and the class that these make."""

    def run(rows: Rows) -> dict | None:
        x, y, e = _arrays(rows)
        n = len(x)
        if n < 20:
            return None
        r, d = y - np.median(y), np.diff(y)
        robust, std = 1.4826 * float(np.median(np.abs(r))), float(y.std())
        eta = float((d * d).sum() / max(n * std * std, 1e-300))
        fit = G.weighted_fit(np.column_stack([np.ones(n), x - np.median(x)]), y, 1 / e**2)
        slope, significance = (float(fit[0][1]), float(fit[0][1] / np.sqrt(max(fit[1][1, 1], 1e-300)))) if fit else (np.nan, 0.0)
        low = r < -3 * robust
        got = G.best_period(x, y, e, shortest=10 / 1440, longest=2 * max(np.ptp(x), 0.02)) or {"period": np.nan, "power": np.nan, "fap": 1.0}
        smooth = (2 - eta) / np.sqrt(4 / (n + 1))
        excess = robust / max(float(np.median(e)), 1e-300)
        periodic, eclipses = got["fap"] <= 1e-3, low.mean() >= 0.01 and (r > 3 * robust).sum() < low.sum()
        kind = "eclipsing" if eclipses and smooth > 3 else "periodic" if periodic and smooth > 3 else "trend" if abs(significance) > 3 and smooth > 3 else "irregular" if excess > 3 or smooth > 3 else "quiet"
        return {"n": n, "rms_robust": robust, "rms_std": std, "chi2": float((r * r / e**2).sum()), "eta": eta, "eta_significance": float(smooth), "slope": slope, "slope_significance": significance,
                "eclipse_share": float(low.mean()), "ls_period": got["period"], "ls_power": got["power"], "ls_fap": got["fap"], "class": kind}

    return per_series(night_series(t).filter("aper = 0"), ["night_id", "star_id"], run, _VARIABLE)


@query("g7_g9_combined_periods")
def _(t: Inputs) -> DataFrame:
    def run(rows: Rows) -> dict | None:
        a = _arrays(rows)
        got = G.best_period(*a)
        fine = got and G.refine_period(*a, got["period"], night=rows["night_id"])
        return got and got | {"refined": fine["period"] if fine else float("nan"), "error": fine["period_err"] if fine else float("nan")}

    return per_series(long_series(t), ["star_id"], run, "period double, power double, fap double, second double, coarsened boolean, refined double, error double")


@query("g8_box_periods")
def _(t: Inputs) -> DataFrame:
    """The best periodic dip of every star over its nights: 0.2 to 30 days, ten periods a resolution element, half an hour to five hours."""

    def run(rows: Rows) -> dict | None:
        a = _arrays(rows)
        span = np.ptp(a[0])
        f, coarsened = G.frequencies(a[0], 0.2, min(30.0, span / 1.5))
        got = G.box_period(*a, 1 / f, np.linspace(0.5, 4.75, 10) / 24) if len(f) else None
        if got is None:
            return None
        inside = np.abs(np.mod(a[0] - got["t0"] + got["period"] / 2, got["period"]) - got["period"] / 2) <= got["duration_h"] / 48
        return got | {"coarsened": coarsened, "nights_in": len(set(rows["night_id"][inside].tolist()))}

    return per_series(long_series(t), ["star_id"], run, "snr double, period double, depth double, duration_h double, t0 double, coarsened boolean, nights_in int")


_ESTIMATE = ("n_nights int, status string, period double, period_err double, power double, fap double, harmonic double, delta double, delta_err double, coverage double, n_cycles double, coarsened boolean, "
             "alias_periods array<double>, alias_powers array<double>")  # fmt: skip


def estimates(t: Inputs, series: DataFrame, **how: bool) -> DataFrame:
    known = t.obj.filter("period > 0").select(c("obj_id").alias("star_id"), c("period").alias("known"))

    def run(series: list[Rows]) -> list[dict]:
        known = [None if np.isnan(rows["known"][0]) else float(rows["known"][0]) for rows in series]
        return G.period_estimates([(*_arrays(rows), rows["night_id"], p, 1e-4 * p if p else 0.0) for rows, p in zip(series, known)], **how)

    return per_series(series.join(known, "star_id", "left"), ["star_id"], run, _ESTIMATE, together=True)


@query("g14_g15_o6_period_estimates")
def _(t: Inputs) -> DataFrame:
    """The period of every star over its nights, refined, compared with its catalogued one, and what it may stand for instead."""
    return estimates(t, long_series(t))


@query("g15_tied_period_estimates")
def _(t: Inputs) -> DataFrame:
    """The same over tied magnitudes, which also show what is slower than a night."""
    return estimates(t, long_series(t, tied(t)), tied=True)


@query("g16_g31_tied_series", f"""
WITH {_tied(3)}, md AS (SELECT night_id, star_id, median(flux) AS med FROM ep WHERE aper = 0 GROUP BY 1, 2)
SELECT e.star_id, e.night_id, e.frame_index, round(bjd_tdb, 6) AS bjd_tdb, round(m - z - 2.5 * log10(flux / med), 5) AS mag, round(sqrt((2.5 / ln(10) * fluxerr / flux) ** 2 + v), 6) AS err
FROM ep e JOIN md ON md.night_id = e.night_id AND md.star_id = e.star_id JOIN k ON k.night_id = e.night_id AND k.star_id = e.star_id JOIN z3 ON z3.night_id = e.night_id JOIN fr f ON f.night_id = e.night_id AND f.frame_index = e.frame_index WHERE e.aper = 0 AND bjd_tdb IS NOT NULL""")
def _(t: Inputs) -> DataFrame:
    return tied(t).select("star_id", "night_id", "frame_index", r6(c("t"), "bjd_tdb"), r6(c("y"), "mag", 5), r6(c("e"), "err"))


@query("g10_g11_trapezoids")
def _(t: Inputs) -> DataFrame:
    """Trapezoids at the best dip of each series of a night that stands out by six sigma, and whether it is seen only in part."""

    def run(rows: Rows) -> dict | None:
        a = _arrays(rows)
        dip = G.box_search(*a)
        if dip is None or dip["snr"] < 6:
            return None
        fit = G.trapezoid_fit(*a, dip["tc"], dip["duration_h"] / 24, dip["depth"])
        return fit and fit | G.incompleteness(a[0], fit["tc"], fit["t14_h"] / 24, dip["flags"])

    schema = ("tc double, tc_err double, t14_h double, t14_err double, depth double, depth_err double, ingress_frac double, chi2_red double, n_points int, converged boolean, t14_lower_limit boolean, reason string, "
              "span_h double, ends_seen boolean")  # fmt: skip
    return per_series(night_series(t).filter("aper = 0"), ["night_id", "star_id"], run, schema)


@query("g11_n12_seen_span", """
WITH d0 AS (SELECT night_id, bjd_tdb AS t, bjd_tdb - lag(bjd_tdb) OVER (PARTITION BY night_id ORDER BY bjd_tdb) AS d FROM fr WHERE bjd_tdb IS NOT NULL),
n AS (SELECT night_id, min(t) AS a, max(t) AS b, median(d) AS u FROM d0 GROUP BY 1), g AS (SELECT night_id, t - d AS g0, t AS g1 FROM d0 JOIN n USING (night_id) WHERE d > 2 * u),
e AS (SELECT det_id, d.night_id, tc_bjd_tdb - duration_h / 48 AS i, tc_bjd_tdb + duration_h / 48 AS o, a, b FROM det d JOIN n ON n.night_id = d.night_id WHERE kind = 'transit' AND tc_bjd_tdb IS NOT NULL AND duration_h > 0)
SELECT e.det_id, i < a AS early, o > b AS late, coalesce(bool_or(i > g0 AND i < g1), false) AND i >= a AS gap_in, coalesce(bool_or(o > g0 AND o < g1), false) AND o <= b AS gap_out,
  round(greatest(0, least(o, b, coalesce(min(CASE WHEN o > g0 AND o < g1 AND o <= b THEN g0 END), o)) - greatest(i, a, coalesce(max(CASE WHEN i > g0 AND i < g1 AND i >= a THEN g1 END), i))) * 24, 5) AS span_h
FROM e LEFT JOIN g ON g.night_id = e.night_id AND ((i > g0 AND i < g1) OR (o > g0 AND o < g1)) GROUP BY e.det_id, i, o, a, b""")
def _(t: Inputs) -> DataFrame:
    """How much of every transit its night shows: ends before the first or after the last frame, or in a gap of twice the median spacing."""
    from lightloom.plans.statistics import cadence

    nights = cadence(t)
    at = Window.partitionBy("night_id").orderBy("bjd_tdb")
    steps = t.fr.filter("bjd_tdb is not null").withColumn("g0", F.lag("bjd_tdb").over(at)).join(nights.select("night_id", "cadence"), "night_id")
    gaps = steps.filter("bjd_tdb - g0 > 2 * cadence").groupBy("night_id").agg(F.collect_list(F.struct("g0", c("bjd_tdb").alias("g1"))).alias("gaps"))  # of one night's frames
    e = t.det.filter("kind = 'transit' and tc_bjd_tdb is not null and duration_h > 0").join(nights, "night_id").join(gaps, "night_id", "left")
    e = e.withColumns({"i": c("tc_bjd_tdb") - c("duration_h") / 48, "o": c("tc_bjd_tdb") + c("duration_h") / 48})
    early, late = c("i") < c("t_first"), c("o") > c("t_last")
    holding = lambda x: F.get(F.filter(c("gaps"), lambda g: (g["g0"] < x) & (x < g["g1"])), F.lit(0))
    e = e.withColumns({"gi": F.when(~early, holding(c("i"))), "go": F.when(~late, holding(c("o")))})
    begin, end = F.greatest("i", "t_first", "gi.g1"), F.least("o", "t_last", "go.g0")
    return e.select("det_id", early.alias("early"), late.alias("late"), c("gi").isNotNull().alias("gap_in"), c("go").isNotNull().alias("gap_out"), r6(F.greatest(F.lit(0.0), end - begin) * 24, "span_h", 5))
