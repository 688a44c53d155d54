"""Epochs of all nights of a star: each epoch read once, medians of all of a night's epochs; and the exactness of the sums over them."""

import datetime as dt
import math
from collections import defaultdict
from statistics import median

import numpy as np
import pytest

from lightloom.functions import kernels as G
from lightloom.plans.registry import Inputs
from lightloom.plans.series import QUERIES, combined


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Frames without a time and one given twice, rows loaded again with another flux, a star of one night, rows without a star or night."""
    at, rng = str(tmp_path_factory.mktemp("combined")), np.random.default_rng(3)
    frames = [(k, n, i, "f", "d", 30.0, 5, True, None if i in (4, 7) else float("nan") if i == 5 else 100.0 * n + i / 50, 1.0, 2.0) for k, (n, i) in enumerate((n, i) for n in (1, 2, 3) for i in range(12))]
    frames.append((99, 1, 3, "f", "d", 30.0, 5, True, 100.5, 1.0, 2.0))
    schema = "frame_id long, night_id int, frame_index int, file_name string, date_obs string, exptime double, n_sources int, kept boolean, bjd_tdb double, airmass double, fwhm double"
    spark.createDataFrame(frames, schema).write.parquet(f"{at}/frame.parquet")
    day = lambda k: dt.datetime(2025, 1, 1) + dt.timedelta(days=k)
    epochs = [(n, s, i, a, float(rng.uniform(1, 2)), 0.01, 50.0, "", day(0)) for n, s in ((1, 1), (2, 1), (3, 1), (1, 2), (1, 3), (3, 3), (None, 2), (1, None), (2, None)) for i in range(13) for a in (0, 1)]
    epochs += [(2, 1, i, 0, 3.0 + i, 0.02, 50.0, "x", day(1)) for i in (0, 4)] + [(3, 1, 2, 0, float("nan"), 0.02, 50.0, "x", day(2)), (3, 3, 1, 0, 1.5, 0.0, 50.0, "x", day(2))]
    spark.createDataFrame(epochs, "night_id int, star_id long, frame_index int, aper int, flux double, fluxerr double, snr float, flags string, loaded_at timestamp").write.parquet(f"{at}/matched_epoch.parquet")
    spark.createDataFrame([(1, float("nan"))], "obj_id long, period double").selectExpr(
        "obj_id", "'' AS name", "1D AS ra", "1D AS dec", "0L AS gaia_id", "12F AS mean_mag", "3 AS n_nights", "'' AS obj_class", "period", "false AS known", "'' AS known_name", "'' AS known_type",
        "'' AS status", "current_timestamp() AS loaded_at", "current_timestamp() AS updated_at", "current_timestamp() AS removed_at").write.parquet(f"{at}/sky_object.parquet")
    return at, frames, epochs


def test_combined_is_as_defined(spark, folder):
    at, frames, epochs = folder
    last = {}
    for n, s, i, a, flux, error, _, _, loaded in sorted(epochs, key=lambda r: r[-1]):
        if a == 0 and s is not None:
            last[n, s, i] = flux, error
    nights = defaultdict(list)
    for (n, s, i), (flux, error) in last.items():
        if flux > 0 and error > 0:
            nights[n, s].append((i, flux, error))
    several = {s for s in (1, 2, 3) if sum(k[1] == s for k in nights) >= 2}
    want = set()
    for (n, s), rows in nights.items():
        m = median(r[1] for r in rows)
        want |= {(s, n, i, f[8], round(flux / m, 9), round(error / m, 9)) for i, flux, error in rows for f in frames if s in several and f[1:3] == (n, i) and f[8] is not None and f[8] == f[8]}
    got = [(r["star_id"], r["night_id"], r["frame_index"], r["t"], round(r["y"], 9), round(r["e"], 9)) for r in combined(Inputs(spark, at)).collect()]
    assert set(got) == want and len(got) == len(want)


def test_epochs_are_read_and_moved_once(spark, folder):
    plan = QUERIES["g14_g15_o6_period_estimates"](spark, folder[0])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("matched_epoch.parquet") == 1 and plan.count("REPARTITION_BY_COL") == 3


def test_fast_sums_lose_nothing_on_short_grids():
    """To 1e-12 of the sum of the terms, on grids of one and a half points a frequency."""
    rng = np.random.default_rng(13)
    for n, m in ((90, 25_679), (400, 34_042), (3_000, 65), (250, 8_193)):
        t, h, f = rng.uniform(0, 60, n), rng.normal(size=(2, n)), np.linspace(1 / 60, 50, m)
        arg = 2 * np.pi * np.outer(t, f[::31])
        for got, plain in zip(G._trig_sums(t, h, f), (h @ np.cos(arg), h @ np.sin(arg))):
            assert (np.abs(got[:, ::31] - plain).max(axis=1) < 1e-12 * np.abs(h).sum(axis=1)).all()


def refined(t, y, e, period, night):
    """The definition, one series at a time: a level per night as columns of the fit's weighted means."""
    w, span, f = 1 / e**2, np.ptp(t), 1 / period
    night = np.zeros(len(t), int) if night is None else night
    in_night = (night[:, None] == np.unique(night)).astype(float)
    level = lambda v: v - in_night @ ((in_night.T @ (w * v)) / (in_night.T @ w))
    z, d, spare = level(y), t - t.mean(), len(t) - in_night.shape[1] - 5
    if spare < 1:
        return None
    for _ in range(8):
        arg = 2 * np.pi * f * d
        flat = np.column_stack([level(g(k * arg)) for k in (1, 2) for g in (np.cos, np.sin)])
        fit = G.weighted_fit(flat, z, w)
        if fit is None:
            return None
        b = fit[0]
        slope = sum(2 * np.pi * k * d * (-b[2 * k - 2] * np.sin(k * arg) + b[2 * k - 1] * np.cos(k * arg)) for k in (1, 2))
        full = G.weighted_fit(np.column_stack([flat, level(slope)]), z, w)
        if full is None:
            return None
        f = float(np.clip(f + full[0][-1], 1 / period - 0.5 / span, 1 / period + 0.5 / span))
        if abs(full[0][-1]) < 1e-10:
            break
    return {"period": 1 / f, "period_err": math.sqrt(max(full[1][-1, -1], 0) * max(1.0, full[2] / spare)) / f**2, "chi2": full[2]}


def test_periods_refined_together_are_those_of_each_series():
    """Series that end early, go to their bound, are too short or flat, with nights that overlap in time or without nights."""
    rng = np.random.default_rng(17)
    series = []
    for k in range(60):
        n = int(rng.integers(20, 140))
        t = 2_460_000 + np.sort(rng.uniform(0, 0.4, n) + rng.integers(0, 9, n))
        night = np.floor(t).astype(int) * 2 + (rng.random(n) < 0.2)
        y = 1 + 0.02 * np.sin(2 * np.pi * t / 0.31) * (k % 3 > 0) + 0.004 * rng.standard_normal(n)
        series.append((t, y, rng.uniform(0.003, 0.005, n), 0.31 * (1 + 0.002 * rng.standard_normal()) if k % 4 else 0.07, None if k % 5 == 0 else night))
    t, y, e, p, _ = series[1]
    series += [(t[:7], y[:7], e[:7], p, None), (t[:12], y[:12], e[:12], p, np.arange(12)), (t, y, e, 1e9, None), (np.full(30, t[0]), y[:30].repeat(2)[:30], np.full(30, 0.01), p, None)]
    got = G.refine_periods(series)
    for one, found, single in zip(series, got, (G.refine_period(*s[:4], night=s[4]) for s in series)):
        want = refined(*one) if len(one[0]) and np.ptp(one[0]) else None
        assert (found is None) == (want is None) == (single is None)
        if want is not None:
            for k in want:
                assert found[k] == pytest.approx(want[k], rel=1e-6) and single[k] == pytest.approx(want[k], rel=1e-6)
    assert sum(x is not None for x in got) >= 60 and G.refine_periods([]) == []


def test_estimates_together_are_those_of_each_series():
    rng = np.random.default_rng(19)
    series = []
    for k in range(12):
        t = np.sort(rng.uniform(0, 0.4, 60) + rng.integers(0, 9, 60))[: 4 if k == 3 else 60]
        y = 1 + 0.02 * np.sin(2 * np.pi * t / (0.3 if k % 2 else 3.1)) + 0.003 * rng.standard_normal(len(t))
        series.append((t, y, np.full(len(t), 0.003), np.floor(t).astype(int), [None, 0.3, 0.6, 900.0][k % 4], 1e-4))
    for tied in (False, True):
        together = G.period_estimates(series, tied=tied)
        assert len({x["status"] for x in together}) >= 3
        for one, got in zip(series, together):
            for k, want in G.period_estimate(*one, tied=tied).items():
                assert got[k] == pytest.approx(want, rel=1e-9) if isinstance(want, (float, list)) else got[k] == want
