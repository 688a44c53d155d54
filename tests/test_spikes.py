"""The spike operator against planted cases, a brute-force reading of the definition, and untidy input."""

import datetime as dt

import numpy as np


from lightloom.operators import spikes
from lightloom.operators.spikes import NORMAL, RANGE, SPIKE, STUCK, SpikeModel, implausible_photometry, judge, posteriors

EPOCHS = "night_id int, star_id long, frame_index int, aper int, flux double, fluxerr double, loaded_at timestamp, field string, r int, ord long"
FRAMES = "night_id int, frame_index int, frame_id long, airmass float, fwhm float, chunk int"
T0 = dt.datetime(2020, 1, 1)


def night(stars=12, n=60, seed=1, cloud=True):
    rng = np.random.default_rng(seed)
    level = rng.uniform(500, 5000, stars)
    common = np.ones(n)
    if cloud:
        common[30:32] = 0.5
    return level[:, None] * common * (1 + 0.01 * rng.standard_normal((stars, n)))


def table(spark, flux, extra=()):
    rows = [(1, 100 + s, f, 0, float(flux[s, f]), 1.0, T0, "x", 0, 0) for s in range(len(flux)) for f in range(flux.shape[1])]
    return spark.createDataFrame(rows + list(extra), EPOCHS)


def found(spark, epochs, frames=None, m=SpikeModel()):
    frames = spark.createDataFrame([] if frames is None else frames, FRAMES)
    return {tuple(r) for r in implausible_photometry(epochs, frames, m).collect()}


def test_planted_cases(spark):
    x = night()
    x[0, 10] *= 1.5  # spike
    x[1, 20:23] *= 0.6  # group of three
    x[2, 20:28] *= 0.6  # a longer change
    x[3, 40:46] = x[3, 40]  # stuck
    x[4, 40:43] = x[4, 40]  # too short
    x[5, 5] = -3.0  # impossible
    x[6, 7] = np.inf
    want = {("flux", 1, 100, 10, 0)} | {("flux", 1, 101, f, 0) for f in (20, 21, 22)} | {("flux", 1, 103, f, 0) for f in range(40, 46)}
    assert found(spark, table(spark, x)) == want | {("flux", 1, 105, 5, 0), ("flux", 1, 106, 7, 0)}


def test_last_loaded_row_counts_and_missing_readings_go(spark):
    x = night()
    again = [
        (1, 100, 10, 0, float(x[0, 10] * 2), 1.0, T0 + dt.timedelta(hours=1), "x", 0, 0),  # a later spike
        (1, 101, 10, 0, -5.0, 1.0, T0 - dt.timedelta(hours=1), "x", 0, 0),  # an earlier impossible value
        (1, 102, 10, 0, None, 1.0, T0 + dt.timedelta(hours=1), "x", 0, 0),  # later missing
        (1, 103, 10, 0, float("nan"), 1.0, T0 + dt.timedelta(hours=1), "x", 0, 0),
        (1, 100, 10, 0, float(x[0, 10] * 2), 1.0, T0 + dt.timedelta(hours=1), "x", 0, 0),  # repeated
        (None, 100, 11, 0, -1.0, 1.0, T0, "x", 0, 0), (1, None, 11, 0, -1.0, 1.0, T0, "x", 0, 0), (1, 100, None, 0, -1.0, 1.0, T0, "x", 0, 0),
        (1, 104, 11, 0, -1.0, 1.0, None, None, None, None),
    ]
    assert found(spark, table(spark, x, again)) == {("flux", 1, 100, 10, 0)}


def test_frames(spark):
    rng = np.random.default_rng(2)
    fwhm, air = 3 + 0.05 * rng.standard_normal(50), 1.1 + 0.01 * np.arange(50)
    fwhm[20], air[10], air[30:32] = 12.0, 0.5, 9.0
    frames = [(7, f, 1000 + f, float(air[f]), float(fwhm[f]), 0) for f in range(50)] + [(7, 50, 1050, None, float("nan"), 0)]
    got = found(spark, spark.createDataFrame([], EPOCHS), frames)
    assert got == {("fwhm", 7, -1, 20, -1), ("airmass", 7, -1, 10, -1), ("airmass", 7, -1, 30, -1), ("airmass", 7, -1, 31, -1)}


def test_empty_and_short(spark):
    assert found(spark, spark.createDataFrame([], EPOCHS)) == set()
    short = [(1, 1, f, 0, v, 1.0, T0, "x", 0, 0) for f, v in enumerate([5.0, 5.0, 5.0, 5.0, 5.0])] + [(1, 2, 0, 0, -1.0, 1.0, T0, "x", 0, 0)]
    assert found(spark, spark.createDataFrame(short, EPOCHS)) == {("flux", 1, 1, f, 0) for f in range(5)} | {("flux", 1, 2, 0, 0)}


def test_long_series_in_chunks_is_judged_as_one(spark):
    rng = np.random.default_rng(3)
    x = 1000 * (1 + 0.01 * rng.standard_normal((1, 700)))
    x[0, [99, 100, 101]] *= 1.4
    x[0, 198:206] = x[0, 198]
    x[0, 450] *= 0.5
    want = {("flux", 1, 100, f, 0) for f in (99, 100, 101, *range(198, 206), 450)}
    assert found(spark, table(spark, x), m=SpikeModel(chunk=100, overlap=32)) == want
    assert found(spark, table(spark, x)) == want


def test_brute_force():
    rng = np.random.default_rng(4)
    x = 1000 * (1 + 0.01 * rng.standard_normal((40, 50)))
    for r in range(40):
        at, size = rng.integers(5, 40), rng.integers(1, 7)
        x[r, at : at + size] += rng.choice([-1, 1]) * rng.choice([40, 300])
    got = judge(x, np.ones_like(x), np.zeros_like(x, bool), SpikeModel())
    for r in range(40):
        v, s = x[r], 1.4826 / np.sqrt(2) * np.median(np.abs(np.diff(x[r]) - np.median(np.diff(x[r]))))
        want = np.zeros(50, bool)
        for g in (1, 2, 3):
            for i in range(1, 50 - g):
                if np.abs(v[i : i + g, None] - [v[i - 1], v[i + g]]).min() > 12 * s and not want[max(0, i - 1) : i + g].any():
                    want[i : i + g] |= np.abs(v[i : i + g] - np.median(v)).min() > 12 * s
        assert (got[r] == want).all()


def test_scatter_is_that_of_the_whole_series(spark):
    """A quiet part of a noisy series is judged by the series' scatter, in whichever chunk it lies."""
    rng = np.random.default_rng(5)
    noise = np.where(np.arange(600) < 200, 0.001, 0.02)
    x = 1000 * (1 + noise * rng.standard_normal(600))[None]
    x[0, 50] *= 1.05  # far for the quiet part, not for the series
    x[0, 400] *= 2
    for m in (SpikeModel(), SpikeModel(chunk=100, overlap=32)):
        assert found(spark, table(spark, x), m=m) == {("flux", 1, 100, 400, 0)}


def test_probabilities():
    z = np.zeros((1, 12))
    z[0, 2], z[0, 5:9] = 30, 25  # a spike, and a change that is too long for one
    no = np.zeros((1, 12), bool)
    g = posteriors(z, no, no, SpikeModel())
    assert np.allclose(g.sum(axis=2), 1)
    assert g[0].argmax(axis=1).tolist() == [SPIKE if t == 2 else NORMAL for t in range(12)]
    for n, kind in ((4, NORMAL), (5, STUCK)):  # a run of four values is none, one of five is
        linked = no.copy()
        linked[0, 3 : 2 + n] = True
        g = posteriors(np.zeros((1, 12)), linked, no, SpikeModel())
        assert g[0].argmax(axis=1).tolist() == [kind if 2 <= t < 2 + n else NORMAL for t in range(12)]
    broken = no.copy()
    broken[0, 3] = True
    assert posteriors(z, no, broken, SpikeModel())[0].argmax(axis=1).tolist()[:5] == [NORMAL, NORMAL, SPIKE, RANGE, NORMAL]


def test_flags_come_from_the_probabilities(monkeypatch):
    """Without the model's verdict nothing but the impossible is flagged, and with everything a spike no group is one."""
    x = 1000 * (1 + 0.01 * np.random.default_rng(6).standard_normal((1, 40)))
    x[0, 10], x[0, 20:26], x[0, 30] = 2000, x[0, 20], -1
    broken = x < 0
    want = judge(x, np.ones_like(x), broken, SpikeModel())
    assert np.flatnonzero(want[0]).tolist() == [10, *range(20, 26), 30]
    for kind in (NORMAL, SPIKE):
        only = np.zeros((1, 40, 4))
        only[:, :, kind] = 1
        monkeypatch.setattr(spikes, "posteriors", lambda *_, only=only: only)
        assert np.flatnonzero(judge(x, np.ones_like(x), broken, SpikeModel())[0]).tolist() == [30]
