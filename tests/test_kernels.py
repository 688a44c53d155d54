"""Kernels recover what is injected."""

import numpy as np
import pytest

from lightloom.functions import kernels as G
from lightloom.functions.scalar import chi2_sf_values


def series(n=200, span=0.25, noise=0.002, seed=0):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.uniform(0, span, n))
    return t, 1 + noise * rng.standard_normal(n), np.full(n, noise)


def test_box_search_finds_a_dip():
    t, y, e = series()
    y[np.abs(t - 0.12) < 0.5 / 24] -= 0.01
    got = G.box_search(t, y, e)
    assert got["snr"] > 10 and abs(got["tc"] - 0.12) < 0.006 and abs(got["depth"] - 0.01) < 0.002 and abs(got["duration_h"] - 1) < 0.3
    assert "STEP_LIKE" not in got["flags"]


def test_box_search_knows_a_step_and_short_series():
    t, y, e = series(seed=1)
    y[t > 0.125] -= 0.01
    got = G.box_search(t, y, e)
    # What wins is no box that a step at its middle or an edge explains as well.
    fit, half = G.Joint(t, y, e), got["duration_h"] / 48
    c, info = fit.terms(np.searchsorted(t, [got["tc"] - half, got["tc"], got["tc"] + half]), np.full(3, len(t)))
    assert "STEP_LIKE" not in got["flags"] and ("PARTIAL" in got["flags"] or got["gain"] - (c * c * info).max() > 3)
    assert G.box_search(t[:5], y[:5], e[:5]) is None
    assert G.box_search(t, np.full(200, np.nan), e) is None


def test_periods():
    rng = np.random.default_rng(2)
    t = np.sort(rng.uniform(0, 30, 300))
    y, e = 1 + 0.02 * np.sin(2 * np.pi * t / 1.234) + 0.003 * rng.standard_normal(300), np.full(300, 0.003)
    got = G.best_period(t, y, e, 0.3, 20)
    assert abs(got["period"] / 1.234 - 1) < 0.01 and got["fap"] < 1e-6
    fine = G.refine_period(t, y, e, got["period"])
    assert abs(fine["period"] - 1.234) < 5 * fine["period_err"] + 1e-5
    white = G.best_period(t, 1 + 0.003 * rng.standard_normal(300), e, 0.3, 20)
    assert white["fap"] > 1e-3
    assert G.best_period(t[:3], y[:3], e[:3]) is None


def test_box_period():
    rng = np.random.default_rng(3)
    t = np.sort(rng.uniform(0, 25, 1500))
    y = 1 + 0.002 * rng.standard_normal(1500)
    y[np.abs((t - 0.7 + 1.1) % 2.2 - 1.1) < 1.2 / 24] -= 0.012
    got = G.box_period(t, y, np.full(1500, 0.002), 1 / np.linspace(1 / 3, 1 / 1.5, 3000), np.array([2.4]) / 24)
    assert abs(got["period"] / 2.2 - 1) < 0.01 and abs(got["depth"] - 0.012) < 0.004


def test_trapezoid():
    t, y, e = series(400, noise=0.001, seed=4)
    y -= 0.02 * np.clip((2 / 48 - np.abs(t - 0.13)) / (0.2 * 2 / 24), 0, 1)
    got = G.trapezoid_fit(t, y, e, 0.128, 1.8 / 24, 0.015)
    assert abs(got["tc"] - 0.13) < 4 * got["tc_err"] + 1e-4 and abs(got["depth"] - 0.02) < 4 * got["depth_err"] + 1e-3
    assert abs(got["t14_h"] - 2) < 4 * got["t14_err"] + 0.05
    assert G.trapezoid_fit(t[:4], y[:4], e[:4], 0.1, 0.1, 0.1) is None


def test_common_trend():
    rng = np.random.default_rng(5)
    trend = np.sin(np.linspace(0, 6, 50))
    cube = 1 + 0.01 * rng.uniform(0.5, 1, 30)[:, None] * trend + 0.001 * rng.standard_normal((30, 50))
    z = np.stack([G.standard(x) for x in cube])
    v, share = G.principal(sum(np.outer(x, x) for x in z))
    _, d, w = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(np.abs(v[0]), np.abs(w[0]), atol=1e-8) and np.isclose(share[0], d[0] ** 2 / (d**2).sum())
    assert abs(np.corrcoef(v[0], trend)[0, 1]) > 0.98 and share[0] > 0.8


@pytest.mark.parametrize("x,k,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (7.814728, 3, 0.05), (18.307038, 10, 0.05), (0.0, 3, 1.0), (20.515006, 5, 0.001)])
def test_chi2(x, k, p):
    assert abs(chi2_sf_values(np.array([x]), np.array([k]))[0] - p) < 1e-6


def test_a_step_does_not_hide_a_dip():
    t, y, e = series(400, noise=0.001, seed=6)
    y[t > 0.19] -= 0.02
    y[np.abs(t - 0.08) < 0.5 / 24] -= 0.006
    got = G.box_search(t, y, e)
    assert got and "STEP_LIKE" not in got["flags"] and (abs(got["tc"] - 0.08) < 0.01 or "PARTIAL" in got["flags"])
    depth, error = G.box_depth(t, y, e, 0.08, 1.0)
    assert 0 < error < 0.01 and G.box_depth(t[:9], y[:9], e[:9], 0.08, 1.0)[0] != depth


def test_joint_fit_is_that_of_least_squares():
    t, y, e = series(80, seed=7)
    fit = G.Joint(t, y, e)
    term = np.zeros(80)
    term[20:35] = 1
    full = G.weighted_fit(np.column_stack([G.drifts(t), term]), y, 1 / e**2)
    c, info = fit.terms(np.array(20), np.array(35))
    assert np.isclose(c, full[0][-1]) and np.isclose(1 / info, full[1][-1, -1]) and np.isclose(fit.chi2 - c * c * info, full[2])
    assert np.allclose(fit.without(20, 35), y - np.column_stack([G.drifts(t), term]) @ full[0])


def test_red_noise():
    rng = np.random.default_rng(8)
    t = np.linspace(0, 1, 2000)
    white = rng.standard_normal(2000)
    assert G.red_noise(white, t, 0.02) < 1.4 and G.red_noise(np.repeat(rng.standard_normal(40), 50), t, 0.02) > 3
    assert G.red_noise(white[:3], t[:3], 0.02) == 1.0 and G.red_noise(white, t, 0.5) == 1.0


def test_fast_sums_agree_with_plain_ones():
    rng = np.random.default_rng(9)
    t, h, f = rng.uniform(0, 70, 3000), rng.uniform(0, 1, 3000), np.linspace(0.02, 50, 9000)
    fast = G._trig_sums(t, h, f)
    arg = 2 * np.pi * np.outer(f[::97], t)
    for got, plain in zip(fast, (np.cos(arg) @ h, np.sin(arg) @ h)):
        assert np.abs(got[::97] - plain).max() < 1e-3 * h.sum()


def nights(period, amplitude=0.02, n=9, seed=10):
    rng = np.random.default_rng(seed)
    t = np.concatenate([k + rng.uniform(0, 0.4) + np.sort(rng.uniform(0, 0.4, 40)) for k in range(n)])
    night = np.repeat(np.arange(n), 40)
    y = 1 + amplitude * np.sin(2 * np.pi * t / period) + 0.002 * rng.standard_normal(len(t))
    level = np.array([np.median(y[night == k]) for k in range(n)])[night]
    return t, y / level, np.full(len(t), 0.002), night


def test_period_estimates():
    for p in (0.3, 0.0713):
        got = G.period_estimate(*nights(p))
        assert abs(got["period"] / p - 1) < 2e-3 and got["status"] == "no_literature" and got["fap"] < 1e-6 and got["period_err"] > 0
        assert 1 <= len(got["alias_periods"]) <= 5 and got["alias_powers"] == sorted(got["alias_powers"], reverse=True)
    t, y, e, night = nights(0.3)
    half = G.period_estimate(t, y, e, night, known=0.6, known_err=1e-4)
    assert half["status"] == "verified" and half["harmonic"] == 0.5 and abs(half["delta"]) < 5 * half["delta_err"] + 1e-3
    assert G.period_estimate(t, y, e, night, known=900.0)["status"] == "lit_period_outside_grid"
    assert G.period_estimate(t, y, e, night, guess=0.29)["period"] == pytest.approx(0.3, rel=5e-3)
    assert G.period_estimate(t[:4], y[:4], e[:4], night[:4])["status"] == "insufficient_data"
    slow = nights(3.1, amplitude=0.3)
    assert G.period_estimate(*slow, known=3.1)["status"] in ("long_period_needs_tie", "no_peak_in_window")


def test_incompleteness():
    t = np.linspace(0, 0.2, 201)
    assert G.incompleteness(t, 0.1, 0.08) == {"t14_lower_limit": False, "reason": "", "span_h": pytest.approx(1.92), "ends_seen": True}
    early = G.incompleteness(t, 0.02, 0.08, "A|EDGE")
    assert early["t14_lower_limit"] and early["reason"] == "flag EDGE; truncated: predicted ingress before the first epoch" and early["span_h"] == pytest.approx(1.44)
    gap = G.incompleteness(t[(t < 0.055) | (t > 0.065)], 0.1, 0.08)
    assert gap["reason"] == "gap covers ingress" and not gap["ends_seen"] and gap["span_h"] < 1.92
    assert not G.incompleteness(t[(t < 0.09) | (t > 0.11)], 0.1, 0.08)["t14_lower_limit"]


def test_long_periods_need_tied_nights():
    """A period of days, which nights of their own level hide, is found and refined where the nights are tied."""
    rng = np.random.default_rng(11)
    t = np.concatenate([k + rng.uniform(0, 0.4) + np.sort(rng.uniform(0, 0.4, 30)) for k in range(20)])
    y, night = 12 + 0.1 * np.sin(2 * np.pi * t / 3.1) + 0.004 * rng.standard_normal(len(t)), np.repeat(np.arange(20), 30)
    got = G.period_estimate(t, y, np.full(len(t), 0.004), night, known=3.1, known_err=0.001, tied=True)
    assert got["status"] == "verified" and got["harmonic"] == 1.0 and abs(got["period"] / 3.1 - 1) < 2e-3 and got["period_err"] > 0
    assert G.period_estimate(t, y, np.full(len(t), 0.004), night, tied=False)["status"] in ("long_period_needs_tie", "no_literature")


def test_fast_sums_are_exact():
    rng = np.random.default_rng(11)
    for n, m in ((900, 40_000), (90, 13_001)):
        t, h, f = rng.uniform(0, 70, n), rng.normal(size=(2, n)), np.linspace(0.02, 50, m)
        arg = 2 * np.pi * np.outer(t, f[::97])
        for got, plain in zip(G._trig_sums(t, h, f), (h @ np.cos(arg), h @ np.sin(arg))):
            assert np.abs(got[:, ::97] - plain).max() < 1e-8


def test_series_come_whole_through_batches(spark):
    """One long series and many short ones, joined by their key before, in batches of a few rows."""
    from pyspark.sql import functions as F

    from lightloom.plans.series import per_series

    rows = spark.range(6000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 500).alias("star"), (-F.col("id")).cast("double").alias("t"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        joined = rows.join(rows.select("star").distinct(), "star", "left_semi")
        got = per_series(joined, ["star"], lambda r: {"n": len(r["t"]), "first": r["t"][0], "none": float("nan")} if r["star"][0] != 3 else None, "n int, first double, none double").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {(r["star"], r["n"], r["first"]) for r in rows.groupBy("star").agg(F.count("*").alias("n"), F.min("t").alias("first")).collect() if r["star"] != 3}
    assert {(r["star"], r["n"], r["first"]) for r in got} == want and len(got) == 499 and all(r["none"] is None for r in got)


def test_red_noise_of_many_widths():
    """With the residuals' scatter told once, and with series too short for eight stretches, as by the definition."""
    rng = np.random.default_rng(12)
    for n, span in ((38, 0.3), (400, 0.3), (7, 0.3)):
        t, r = np.sort(rng.uniform(0, span, n)), np.cumsum(rng.standard_normal(n))
        one = 1.4826 * np.median(np.abs(r - np.median(r)))
        for width in (*G.DURATIONS, np.ptp(t) / 7):
            k = ((t - t[0]) / width).astype(int)
            means = np.array([r[k == j].mean() for j in np.unique(k)])
            want = 1.4826 * np.median(np.abs(means - np.median(means))) / (one / np.sqrt(n / len(means))) if len(means) >= 8 else 1.0
            assert G.red_noise(r, t, width, one=one) == pytest.approx(max(1.0, want)) == pytest.approx(G.red_noise(r, t, width))
