"""Numeric kernels over one series, in numpy: fits, box search, periodograms, trapezoids.

They are called from grouped Arrow functions (``plans.series``); each takes arrays of one series and returns plain
numbers, never raises on degenerate input, and answers None or NaN where a series is too short.
"""

from __future__ import annotations

import math
from collections.abc import Generator
from functools import lru_cache

import numpy as np


def weighted_fit(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Coefficients, covariance and chi-squared of weighted least squares; None if singular or under-determined."""
    if len(y) - x.shape[1] < 3:
        return None
    m = x.T @ (w[:, None] * x)
    try:
        cov, size = np.linalg.inv(m), np.abs(np.linalg.eigvalsh(m))
    except np.linalg.LinAlgError:
        return None
    if not np.isfinite(cov).all() or size.max() > 1e14 * size.min():
        return None
    beta = cov @ (x.T @ (w * y))
    r = y - x @ beta
    return beta, cov, float((w * r * r).sum())


def drifts(t: np.ndarray, degree: int = 2) -> np.ndarray:
    """Powers of time about the median, scaled to the span."""
    d = t - np.median(t)
    return (d / max(np.ptp(t), 1e-12))[:, None] ** np.arange(degree + 1)


def clip_outliers(y: np.ndarray, window: int = 15, sigma: float = 6.0) -> np.ndarray:
    """True for values within ``sigma`` robust deviations of a running median whose ends repeat the end values."""
    h = window // 2
    wide = np.concatenate([np.full(h, y[0]), y, np.full(h, y[-1])])
    r = y - np.median(np.lib.stride_tricks.sliding_window_view(wide, 2 * h + 1), axis=1)
    mad = 1.4826 * np.median(np.abs(r - np.median(r)))
    return np.abs(r) <= sigma * mad if mad > 0 else np.ones(len(y), bool)


#: Box search: durations in days, least points in a box and on each side of a step, least part of a box within the data.
DURATIONS = np.linspace(0.4, 2.5, 15) / 24
LEAST_IN, LEAST_SIDE, LEAST_COVERAGE, STEP_GAIN = 5, 10, 0.5, 3.0


class Joint:
    """The joint fit of slow drifts and one more term, for any term that is an indicator of a stretch of time.

    By the Frisch-Waugh-Lovell theorem such a term needs only its sums of weight, weighted residual and weighted drift
    terms, so a whole grid costs one pass of prefix sums.
    """

    def __init__(self, t: np.ndarray, y: np.ndarray, e: np.ndarray, extra: np.ndarray | None = None):
        self.t, self.w = t, 1 / e**2
        self.x = drifts(t) if extra is None else np.concatenate([drifts(t), extra], axis=1)
        self.fit = weighted_fit(self.x, y, self.w)
        if self.fit is None:
            return
        beta, self.cov, self.chi2 = self.fit
        self.r = y - self.x @ beta  # orthogonal to x in w: a term's covariance with y is that with r
        zero = np.zeros((1, self.x.shape[1]))
        self.sums = np.concatenate([[0], np.cumsum(self.w)]), np.concatenate([[0], np.cumsum(self.w * self.r)]), np.concatenate([zero, np.cumsum(self.w[:, None] * self.x, axis=0)])

    def terms(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(coefficient, information) of the indicators of points i to j; the gain in chi-squared is coefficient**2 * information."""
        sw, sr, sx = (s[j] - s[i] for s in self.sums)
        information = sw - np.einsum("...p,pq,...q->...", sx, self.cov, sx)
        good = information > 1e-9 * np.maximum(sw, 1e-300)
        return np.where(good, sr / np.where(good, information, 1), 0.0), np.where(good, information, 0.0)

    def without(self, i: int, j: int) -> np.ndarray:
        """Residuals of the joint fit with the indicator of points i to j."""
        c, _ = self.terms(np.array(i), np.array(j))
        term = np.zeros(len(self.t))
        term[i:j] = 1
        return self.r - float(c) * (term - self.x @ (self.cov @ (self.x.T @ (self.w * term))))


def _ready(t: np.ndarray, y: np.ndarray, e: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Finite, unclipped points in order of time, and their places; None if fewer than ``least``."""
    order = np.argsort(t, kind="stable")
    order = order[np.isfinite(t[order]) & np.isfinite(y[order]) & np.isfinite(e[order]) & (e[order] > 0)]
    if len(order) < least:
        return None
    order = order[clip_outliers(y[order])]
    return (t[order], y[order], e[order], order) if len(order) >= least else None


def box_search(
    t: np.ndarray, y: np.ndarray, e: np.ndarray, durations: np.ndarray | None = None, nuisance: np.ndarray | None = None, least: int = 20
) -> dict | None:
    """The box-shaped dip of greatest signal to noise, fitted jointly with slow drifts over a grid of times and durations.

    Boxes wholly within the data that a single step (at their middle or an edge) explains as well are left out, so that a
    step does not hide a dip elsewhere.  Signal to noise is divided by
    the red noise at the duration, taken from what the best dip leaves; as the best dip depends on it in turn, both are
    repeated until they agree, three times at most.  ``durations`` in days; None with fewer than ``least`` good points.
    """
    ready = _ready(t, y, e, least)
    if ready is None:
        return None
    t, y, e, order = ready
    fit = Joint(t, y, e, None if nuisance is None else nuisance[order])
    n, spare = len(t), len(t) - fit.x.shape[1] - 1
    if fit.fit is None or spare < 1:
        return None
    d = (DURATIONS if durations is None else durations)[:, None]
    centre = np.arange(t[0] - d.max() / 2, t[-1] + d.max() / 2 + d.min() / 4, d.min() / 4)[None, :]
    low, high = centre - d / 2, centre + d / 2
    i, j = np.searchsorted(t, low, "left"), np.searchsorted(t, high, "right")
    covered = np.clip(np.minimum(high, t[-1]) - np.maximum(low, t[0]), 0, None) / d
    c, info = fit.terms(i, np.maximum(i, j))
    left = fit.chi2 - c * c * info
    # The gain of a step at each data point; a box is compared with those at its edges and middle.
    at = np.arange(n + 1)
    step, step_info = fit.terms(at, np.full(n + 1, n))
    gain = np.where((at >= LEAST_SIDE) & (at <= n - LEAST_SIDE), step * step * step_info, -np.inf)
    steps = np.maximum.reduce([gain[np.searchsorted(t, np.clip(x, t[0], t[-1]))] for x in (low, np.broadcast_to(centre, low.shape), high)])
    full = covered >= 0.999
    like_step = full & (fit.chi2 - steps - left <= STEP_GAIN)
    ok = (j - i >= LEAST_IN) & (covered >= LEAST_COVERAGE) & (c < 0) & (info > 0) & (left > 0) & ~like_step
    if not ok.any():
        return None
    white = np.where(ok, -c * np.sqrt(info * spare / np.where(left > 0, left, 1)), -np.inf)
    best, beta = np.unravel_index(int(np.argmax(white)), white.shape), np.ones(len(d))
    for _ in range(3):
        rest = fit.without(int(i[best]), int(j[best]))
        one = _scatter(rest)
        beta = np.array([red_noise(rest, t, x, one=one) for x in d[:, 0]])
        again = np.unravel_index(int(np.argmax(white / beta[:, None])), white.shape)
        if again == best:
            break
        best = again
    k, tc, wide = best[0], float(centre[0, best[1]]), float(d[best[0], 0])
    edge = 0.25 * wide
    flags = {
        "EDGE": low[best] <= t[0] + edge or high[best] >= t[-1] - edge, "TOO_DEEP": -c[best] > 0.3, "FEW_POINTS": j[best] - i[best] < 8, "HIGH_BETA": beta[k] > 3, "PARTIAL": not full[best],
        "STEP_LIKE": bool(like_step[best]),
    }
    return {
        "snr": float(white[best] / beta[k]), "depth": float(-c[best]), "tc": tc, "duration_h": wide * 24, "n_in": int(j[best] - i[best]), "coverage": float(min(covered[best], 1.0)),
        "beta": float(beta[k]), "error": float(np.sqrt(left[best] / spare / info[best])), "gain": float(fit.chi2 - left[best]), "flags": "|".join(k for k, v in flags.items() if v),
    }


def box_depth(t: np.ndarray, y: np.ndarray, e: np.ndarray, tc: float, duration_h: float, least: int = 20) -> tuple[float, float]:
    """(depth, error) of a box given in time and duration, fitted jointly with slow drifts; NaN where the data cannot tell."""
    ready = _ready(t, y, e, least)
    if ready is None:
        return math.nan, math.nan
    t, y, e, _ = ready
    fit = Joint(t, y, e)
    i, j = (int(np.searchsorted(t, tc + s * duration_h / 48, side)) for s, side in ((-1, "left"), (1, "right")))
    spare = len(t) - fit.x.shape[1] - 1
    if fit.fit is None or spare < 1 or j - i < 1:
        return math.nan, math.nan
    c, info = (float(v) for v in fit.terms(np.array(i), np.array(j)))
    return (-c, math.sqrt(max(fit.chi2 - c * c * info, 0) / spare / info)) if info > 0 else (math.nan, math.nan)


def _scatter(x: np.ndarray) -> float:
    """Robust scatter of finite values; ``np.median`` costs more than these short series do."""

    def median(v: np.ndarray) -> float:
        v = np.sort(v)
        return (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2

    return 1.4826 * median(np.abs(x - median(x)))


def red_noise(r: np.ndarray, t: np.ndarray, width: float, least: int = 8, one: float | None = None) -> float:
    """Scatter of residuals' means over stretches of ``width`` days, over what white noise would give; 1 at least (Pont et al. 2006).

    ``one``: the residuals' own scatter, where it is known.
    """
    if len(r) < 4 or width <= 0 or t[-1] - t[0] < (least - 1) * width * (1 - 1e-9):  # too short for so many stretches
        return 1.0
    one = _scatter(r) if one is None else one
    if one <= 0:
        return 1.0
    k = ((t - t[0]) / width).astype(int)
    n = np.bincount(k)
    some = n > 0
    if some.sum() < least:
        return 1.0
    m = np.bincount(k, r)[some] / n[some]
    return float(max(1.0, _scatter(m) / (one / math.sqrt(n[some].mean()))))


#: Points to which the fast sums spread a term, least ratio of their grid to the frequencies, and the kernel's shape for both: an error of about 1e-12 of the terms' sum.
SPREAD, RATIO = 18, 1.5
SHAPE = math.pi * SPREAD * (1 - 1 / (2 * RATIO))


def _spreading(degree: int = 17, nodes: int = 60) -> np.ndarray:
    """Kaiser-Bessel weights of the ``SPREAD`` points (columns) as polynomials, highest power first, of where a term lies between two points (-1 to 1)."""
    v = np.cos(np.pi * (np.arange(nodes) + 0.5) / nodes)
    z = ((v[:, None] + 1) / 2 + np.arange(SPREAD)) * 2 / SPREAD - 1
    return np.linalg.lstsq(np.vander(v, degree + 1), np.i0(SHAPE * np.sqrt(1 - z * z)) * math.exp(-SHAPE), rcond=None)[0]


_WEIGHTS = _spreading()
#: Lengths that transform fast.
_LENGTHS = np.array(sorted(2**a * 3**b * 5**c for a in range(21) for b in range(13) for c in range(9) if 2**a * 3**b * 5**c < 1 << 20))


@lru_cache(maxsize=2)
def _scale(n: int, size: int) -> np.ndarray:
    """One over the transform of the weights; its hyperbolic sine is half an exponential here."""
    k = np.arange(-(n // 2), n - n // 2) * (np.pi * SPREAD / size)
    root = np.sqrt(SHAPE * SHAPE - k * k)
    return root * np.exp(SHAPE - root) * (2 / SPREAD)


def _trig_sums(t: np.ndarray, h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of h * cos and h * sin of 2 pi f t over a uniform grid of frequencies; of each row of ``h`` where it has several.

    Few terms are summed as they are; many are spread to a time grid of one and a half points a frequency by Kaiser-Bessel
    weights, transformed and divided by the weights' transform (Fessler & Sutton 2003).
    """
    n, half = len(f), len(f) // 2
    if len(t) * n <= 20_000 or n < 64:
        arg = 2 * np.pi * np.outer(t, f)
        return h @ np.cos(arg), h @ np.sin(arg)
    least = max(math.ceil(RATIO * n), n + 2 * SPREAD)
    size = int(_LENGTHS[np.searchsorted(_LENGTHS, least)]) if least <= _LENGTHS[-1] else least
    x = np.mod(t * ((f[-1] - f[0]) / (n - 1)), 1.0) * size
    first = np.ceil(x - SPREAD / 2)
    weights = np.vander(2 * (first - x) + SPREAD - 1, len(_WEIGHTS)) @ _WEIGHTS
    cell = ((first.astype(np.int64)[:, None] + np.arange(SPREAD)) % size).ravel()
    turned = h * np.exp(2j * np.pi * f[half] * t)
    scale = _scale(n, size)
    real, imag = np.empty((*h.shape[:-1], n)), np.empty((*h.shape[:-1], n))
    for value, a, b in zip(turned.reshape(-1, len(t)), real.reshape(-1, n), imag.reshape(-1, n)):
        grid = np.zeros(size, complex)
        np.add.at(grid, cell, (weights * value[:, None]).ravel())
        np.fft.ifft(grid, norm="forward", out=grid)
        z = np.concatenate([grid[size - half :], grid[: n - half]])
        np.multiply(z.real, scale, out=a)
        np.multiply(z.imag, scale, out=b)
    return real, imag


def lomb_scargle(t: np.ndarray, y: np.ndarray, e: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Generalised (floating mean, weighted) Lomb-Scargle power in [0, 1] at uniform frequencies ``f`` (Zechmeister & Kuerster 2009)."""
    w = 1 / e**2
    w = w / w.sum()
    yc = y - (w * y).sum()
    yy = (w * yc * yc).sum()
    if yy <= 0 or not len(f):
        return np.zeros(len(f))
    t = t - t.min()
    (mc, yc_c), (ms, yc_s) = _trig_sums(t, np.stack([w, w * yc]), f)
    c2, s2 = _trig_sums(2 * t, w, f)  # of the doubled angle
    cc, ss, cs = (1 + c2) / 2 - mc * mc, (1 - c2) / 2 - ms * ms, s2 / 2 - mc * ms
    d = cc * ss - cs * cs
    with np.errstate(all="ignore"):
        p = (ss * yc_c**2 + cc * yc_s**2 - 2 * cs * yc_c * yc_s) / (yy * d)
    return np.where(d > 1e-9, np.clip(p, 0, 1), 0.0)


def baluev_fap(power: float, n: int, fmax: float, t: np.ndarray, e: np.ndarray) -> float:
    """Bound of the false-alarm probability of a peak of standard normalisation (Baluev 2008)."""
    if n < 5:
        return 1.0
    w = 1 / e**2
    m = (w * t).sum() / w.sum()
    width = fmax * math.sqrt(4 * math.pi * (w * (t - m) ** 2).sum() / w.sum())
    gamma = math.sqrt(2 / (n - 1)) * math.exp(math.lgamma((n - 1) / 2) - math.lgamma((n - 2) / 2))
    single = (1 - power) ** ((n - 3) / 2)
    tau = gamma * width * (1 - power) ** ((n - 4) / 2) * math.sqrt(max((n - 1) * power / 2, 0))
    return float(min(1.0, max(0.0, single + tau - single * tau))) if tau < 50 else 1.0


#: Points that a grid of frequencies may have; beyond, its step is widened and the result says so.
MOST_FREQUENCIES = 200_000


def frequencies(t: np.ndarray, shortest: float, longest: float, over: int = 10, most: int = MOST_FREQUENCIES) -> tuple[np.ndarray, bool]:
    """(grid, coarsened): from the longest period within the span to the shortest, ``over`` points a resolution element."""
    span = max(np.ptp(t), 1e-9) if len(t) else 1e-9
    low, high = 1 / min(longest, span), 1 / shortest
    if high <= low:
        return np.zeros(0), False
    n = int((high - low) * over * span) + 1
    return np.linspace(low, high, max(min(n, most), 2)), n > most


def best_period(t: np.ndarray, y: np.ndarray, e: np.ndarray, shortest: float = 0.02, longest: float = 100.0, most: int = MOST_FREQUENCIES) -> dict | None:
    """The highest peak of the periodogram, its false-alarm probability, and the highest one that is not within a hundredth of it."""
    if len(t) < 6:
        return None
    f, coarsened = frequencies(t, shortest, longest, most=most)
    if not len(f):
        return None
    p = lomb_scargle(t, y, e, f)
    k = int(np.argmax(p))
    far = np.abs(f - f[k]) > 0.01 * f[k]
    second = int(np.flatnonzero(far)[np.argmax(p[far])]) if far.any() else k
    return {"period": float(1 / f[k]), "power": float(p[k]), "fap": baluev_fap(float(p[k]), len(t), float(f[-1]), t, e), "second": float(1 / f[second]), "coarsened": coarsened}


#: Harmonics of a known period at which a measured one may be found.
HARMONICS = (0.5, 1.0, 2.0)


def window_peak(f: np.ndarray, power: np.ndarray, period: float, width: float, long: float = math.inf) -> tuple[tuple[int, float] | None, str]:
    """((grid index, harmonic) or None, status): the best local maximum within ``width`` of a period's harmonics.

    A maximum on the grid's end is no peak for windows about periods beyond ``long``.
    """
    padded = np.concatenate([[-np.inf], power, [-np.inf]])
    best, seen = None, False
    for h in HARMONICS:
        a, b = np.searchsorted(f, 1 / (period * h * (1 + width)), "left"), np.searchsorted(f, 1 / (period * h * (1 - width)), "right")
        if a >= b:
            continue
        seen = True
        k = a + int(np.argmax(power[a:b]))
        if period * h > long and k in (0, len(f) - 1):
            continue
        if power[k] >= max(padded[k], padded[k + 2]) and (best is None or power[k] > power[best[0]]):
            best = (k, h)
    return best, "verified" if best else "no_peak_in_window" if seen else "lit_period_outside_grid"


def aliases(t: np.ndarray, y: np.ndarray, e: np.ndarray, f: np.ndarray, power: np.ndarray, k: int, most: int = 5) -> tuple[list[float], list[float]]:
    """(periods, powers) of what the peak at ``f[k]`` may stand for instead, the strongest first.

    One cycle a day more and less always belong; two a day and the next peaks, at least a resolution element from all
    others, fill up to ``most``.
    """
    apart, taken = 1 / max(np.ptp(t), 1e-9), [float(f[k])]

    def take(wanted: list[float], gap: float, room: int) -> list[float]:
        out = []
        for g in wanted:
            if len(out) < room and f[0] <= g <= f[-1] and all(abs(g - h) > gap for h in taken):
                out.append(g)
                taken.append(g)
        return out

    day = take([abs(f[k] + s) for s in (1.0, -1.0)], 1e-9, 2)
    room = max(most - len(day), 0)
    others = take([abs(f[k] + s) for s in (2.0, -2.0)], 1e-9, 2)
    tops = np.flatnonzero((power[1:-1] > power[:-2]) & (power[1:-1] >= power[2:])) + 1
    others += take(f[tops[np.argsort(-power[tops], kind="stable")][: 200 + room]].tolist(), apart, room)
    strength = dict(zip((*day, *others), lomb_scargle(t, y, e, np.array([*day, *others])).tolist()))
    kept = sorted([*day, *sorted(others, key=lambda g: -strength[g])[:room]], key=lambda g: -strength[g])
    return [1 / g for g in kept], [strength[g] for g in kept]


def phase_stats(t: np.ndarray, period: float, bins: int = 20) -> tuple[float, float]:
    """(share of phase bins with a point, cycles that the data span)."""
    k = np.minimum((np.mod(t - t.min(), period) / period * bins).astype(int), bins - 1)
    return len(np.unique(k)) / bins, float(np.ptp(t) / period)


#: A series to be refined: times, values, errors, period, and the night of each point or None.
ToRefine = tuple[np.ndarray, np.ndarray, np.ndarray, float, np.ndarray | None]


def _estimating(
    t: np.ndarray, y: np.ndarray, e: np.ndarray, night: np.ndarray, known: float | None = None, known_err: float = 0.0, guess: float | None = None, tied: bool = False,
    shortest: float = 0.02, longest: float = 100.0, long: float = 1.0, window: float = 0.05, guided: float = 0.2,
) -> Generator[ToRefine, dict | None, dict]:
    """``period_estimate`` in two steps, between which it asks for a period to be refined.

    The period of a star over its nights, and how it compares with a known one.

    The peak is the highest of all, or with a guess or a known period the highest within its windows.  A period beyond ``long`` days
    cannot be measured on nights that each have their own level (``tied`` says that they do not).  All others are refined by a
    Fourier series with an offset per night.  ``status``: verified, no_literature, no_peak_in_window,
    lit_period_outside_grid, long_period_needs_tie or insufficient_data.
    """
    none = dict.fromkeys(("period", "period_err", "power", "fap", "harmonic", "delta", "delta_err", "coverage", "n_cycles"), None)
    out = none | {"n_nights": len(np.unique(night)), "alias_periods": None, "alias_powers": None, "coarsened": False}
    f, coarsened = frequencies(t, shortest, longest)
    if len(t) < 6 or not len(f):
        return out | {"status": "insufficient_data"}
    out["coarsened"] = coarsened
    power = lomb_scargle(t, y, e, f)
    k, harmonic, status = int(np.argmax(power)), None, "no_literature"
    if guess:
        best, status = window_peak(f, power, guess, guided, long)
        if best is None:
            return out | {"status": status}
        k = best[0]
    elif known:
        best, status = window_peak(f, power, known, window, long)
        k, harmonic = best or (k, None)
    period = float(1 / f[k])
    if out["n_nights"] >= 2:
        out["alias_periods"], out["alias_powers"] = aliases(t, y, e, f, power, k)
    out |= {"power": float(power[k])}
    if period > long and not tied:
        coverage, cycles = phase_stats(t, period)
        return out | {"period": period, "coverage": coverage, "n_cycles": cycles, "status": "long_period_needs_tie"}
    fine = yield t, y, e, period, None if period > long else night
    error = None
    if fine is not None:
        period, error = fine["period"], fine["period_err"]
    if guess and known:
        off = [abs(period / h - known) / known for h in HARMONICS]
        near = int(np.argmin(off))
        harmonic, status = (HARMONICS[near], "verified") if off[near] <= window else (None, "no_peak_in_window")
    elif guess:
        status = "no_literature"
    if known and harmonic:
        out |= {"harmonic": harmonic, "delta": period / harmonic - known, "delta_err": None if error is None else math.hypot(error / harmonic, known_err)}
    coverage, cycles = phase_stats(t, period)
    return out | {"period": period, "period_err": error, "fap": baluev_fap(out["power"], len(t), float(f[-1]), t, e), "coverage": coverage, "n_cycles": cycles, "status": status}


def period_estimates(series: list[tuple], **how: float | bool) -> list[dict]:
    """``period_estimate`` of each series' arguments; all are refined together."""
    out: list[dict] = [{}] * len(series)
    asked = []
    for i, one in enumerate(series):
        steps = _estimating(*one, **how)
        try:
            asked.append((i, steps, next(steps)))
        except StopIteration as told:
            out[i] = told.value
    for (i, steps, _), fine in zip(asked, refine_periods([a for *_, a in asked])):
        try:
            steps.send(fine)
        except StopIteration as told:
            out[i] = told.value
    return out


def period_estimate(*one: np.ndarray | float | None, **how: float | bool | None) -> dict:
    """The period of a star over its nights, and how it compares with a known one (arguments of ``_estimating``)."""
    return period_estimates([one], **how)[0]


def box_period(t: np.ndarray, y: np.ndarray, e: np.ndarray, periods: np.ndarray, durations: np.ndarray, bins: int = 200, chunk: int = 256) -> dict | None:
    """Box least squares over folded bins: period, duration and start of greatest signal to noise (Kovacs et al. 2002)."""
    if len(t) < 20 or not len(periods):
        return None
    w = 1 / e**2
    r = y - (w * y).sum() / w.sum()
    total, since = w.sum(), t - t.min()
    chunk = max(1, min(chunk, 4_000_000 // len(t)))
    best = None
    for a in range(0, len(periods), chunk):
        p = periods[a : a + chunk, None]
        cell = np.minimum((np.mod(since / p, 1.0) * bins).astype(np.int64), bins - 1) + np.arange(len(p))[:, None] * bins
        bw, br = (np.bincount(cell.ravel(), np.broadcast_to(v, cell.shape).ravel(), len(p) * bins).reshape(-1, bins) for v in (w, w * r))
        cw, cr = (np.concatenate([np.zeros((len(p), 1)), np.cumsum(np.concatenate([v, v], axis=1), axis=1)], axis=1) for v in (bw, br))
        for d in durations:
            wide = np.maximum(1, np.rint(d / p[:, 0] * bins).astype(int))
            for q in np.unique(wide[wide < bins // 2]):
                rows = np.flatnonzero(wide == q)
                sw, sr = cw[rows, q : q + bins] - cw[rows, :bins], cr[rows, q : q + bins] - cr[rows, :bins]
                with np.errstate(all="ignore"):
                    depth = -sr / sw - sr / (total - sw)
                    snr = np.where((sw > 0) & (sw < total), depth * np.sqrt(sw * (total - sw) / total), -np.inf)
                i, m = np.unravel_index(int(np.argmax(snr)), snr.shape)
                if best is None or snr[i, m] > best["snr"]:
                    period = float(p[rows[i], 0])
                    best = {"snr": float(snr[i, m]), "period": period, "depth": float(depth[i, m]), "duration_h": float(d * 24), "t0": float(t.min() + (m + q / 2) / bins * period)}
    return best


def _fits(x: np.ndarray, z: np.ndarray, w: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``weighted_fit`` of series that lie behind one another: columns ``x`` (column, row), each series' first row and number of rows.

    (which could be fitted, coefficients, covariances, chi-squared), a row per series.
    """
    k, wx = len(x), w * x
    m = np.empty((len(starts), k, k))
    for i in range(k):
        m[:, i, i:] = m[:, i:, i] = np.add.reduceat(wx[i] * x[i:], starts, axis=1).T
    good = np.isfinite(m).all(axis=(1, 2))
    m[~good] = np.eye(k)
    value = np.abs(np.linalg.eigvalsh(m))
    least, most = value.min(axis=1), value.max(axis=1)
    good &= (least > 0) & (most <= 1e14 * least)
    m[~good] = np.eye(k)
    cov = np.linalg.inv(m)
    beta = (cov @ np.add.reduceat(wx * z, starts, axis=1).T[:, :, None])[:, :, 0]
    r = z - (np.repeat(beta.T, size, axis=1) * x).sum(axis=0)
    return good, beta, cov, np.add.reduceat(w * r * r, starts)


def refine_periods(series: list[ToRefine], terms: int = 2, rounds: int = 8) -> list[dict | None]:
    """Frequency of a Fourier series fitted to each series by Gauss-Newton within half a resolution element, with its error.

    Where each point's night is told every night has its own level (its weighted mean is taken from all columns).  Rounds
    are taken by all series at once, each until its own end; their rows lie behind one another, by night.
    """
    out: list[dict | None] = [None] * len(series)
    which = np.array([i for i, s in enumerate(series) if len(s[0]) - 2 * terms - 1 >= 3], int)
    if not len(which):
        return out
    size = np.array([len(series[i][0]) for i in which])
    t, y, e = (np.concatenate([series[i][k] for i in which]) for k in range(3))
    star = np.repeat(np.arange(len(which)), size)
    night = np.concatenate([np.zeros(len(series[i][0]), int) if series[i][4] is None else np.unique(series[i][4], return_inverse=True)[1] for i in which])
    order = np.lexsort((night, star))
    t, y, w, night = t[order], y[order], 1 / e[order] ** 2, night[order]
    starts = np.cumsum(size) - size
    span = np.maximum(np.maximum.reduceat(t, starts) - np.minimum.reduceat(t, starts), 1e-9)
    begun = np.flatnonzero(np.concatenate([[True], (star[1:] != star[:-1]) | (night[1:] != night[:-1])]))
    spare = size - np.bincount(star[begun], minlength=len(which)) - 2 * terms - 1
    d = t - np.repeat(np.array([series[i][0].mean() for i in which]), size)
    f0 = np.array([1 / series[i][3] for i in which])

    def level(v: np.ndarray) -> np.ndarray:
        many = np.diff(np.append(begun, len(w)))
        return v - np.repeat(np.add.reduceat(w * v, begun, axis=-1) / np.add.reduceat(w, begun), many, axis=-1)

    z, f, going = level(y), f0.copy(), spare >= 1
    for turn in range(rounds):
        if not going.all():  # rows of series that have ended go
            row, group = np.repeat(going, size), going[star[begun]]
            first = np.zeros(len(w), bool)
            first[begun[group]] = True
            begun = np.flatnonzero(first[row])
            d, w, z = d[row], w[row], z[row]
            which, size, span, spare, f0, f = which[going], size[going], span[going], spare[going], f0[going], f[going]
            star, starts = np.repeat(np.arange(len(which)), size), np.cumsum(size) - size
        if not len(which):
            break
        arg = 2 * np.pi * np.repeat(f, size) * d
        raw = np.stack([g(k * arg) for k in range(1, terms + 1) for g in (np.cos, np.sin)])
        flat = level(raw)
        fitted, b, _, _ = _fits(flat, z, w, starts, size)
        b = np.repeat(b.T, size, axis=1)
        slope = sum(2 * np.pi * k * d * (-b[2 * k - 2] * raw[2 * k - 1] + b[2 * k - 1] * raw[2 * k - 2]) for k in range(1, terms + 1))
        good, beta, cov, chi2 = _fits(np.concatenate([flat, level(slope)[None]]), z, w, starts, size)
        good &= fitted
        step, before = beta[:, -1], f
        f = np.clip(f + step, f0 - 0.5 / span, f0 + 0.5 / span)
        going = good & (np.abs(step) >= 1e-10) & (f != before)  # one that stays at its bound would stay there
        for i in np.flatnonzero(good & ~going if turn < rounds - 1 else good):
            sf = math.sqrt(max(cov[i, -1, -1], 0) * max(1.0, chi2[i] / spare[i]))
            out[which[i]] = {"period": float(1 / f[i]), "period_err": float(sf / f[i] ** 2), "chi2": float(chi2[i])}
    return out


def refine_period(t: np.ndarray, y: np.ndarray, e: np.ndarray, period: float, terms: int = 2, rounds: int = 8, night: np.ndarray | None = None) -> dict | None:
    """``refine_periods`` of one series."""
    return refine_periods([(t, y, e, period, night)], terms, rounds)[0]


def trapezoid_fit(t: np.ndarray, y: np.ndarray, e: np.ndarray, tc: float, total: float, depth: float, rounds: int = 60) -> dict | None:
    """Trapezoid dip on a constant level by damped least squares; times in days.  Parameters: tc, T14, depth, ingress share, level."""
    near = np.abs(t - tc) <= max(1.5 * total, total + 1 / 24)
    t, y, e = t[near], y[near], e[near]
    if len(t) < 8:
        return None
    low = np.array([tc - total / 2, 0.2 * total, 0.0, 0.0, -np.inf])
    high = np.array([tc + total / 2, 3 * total, 1.0, 0.5, np.inf])
    out = np.abs(t - tc) > total / 2
    q = np.array([tc, total, max(depth, 1e-5), 0.2, float(np.median(y[out])) if out.any() else 1.0])

    def model(q: np.ndarray) -> np.ndarray:
        return q[4] - q[2] * np.clip((q[1] / 2 - np.abs(t - q[0])) / max(q[3] * q[1], 1e-3 * q[1]), 0, 1)

    size = np.array([total * 1e-3, total * 1e-3, 1e-5, 1e-3, 1e-6])
    damp, r, done = 1e-2, (y - model(q)) / e, False
    for _ in range(rounds):
        j = np.column_stack([(model(q + np.eye(5)[k] * size[k]) - model(q - np.eye(5)[k] * size[k])) / (2 * size[k]) / e for k in range(5)])
        a, g = j.T @ j, j.T @ r
        try:
            step = np.linalg.solve(a + damp * np.diag(np.maximum(np.diag(a), 1e-12)), g)
        except np.linalg.LinAlgError:
            return None
        new = np.clip(q + step, low, high)
        rn = (y - model(new)) / e
        if (rn @ rn) < (r @ r):
            done = (r @ r) - (rn @ rn) < 1e-8 * (r @ r)
            q, r, damp = new, rn, damp / 3
        else:
            damp *= 4
            done = damp > 1e8
        if done:
            break
    chi2r = float(r @ r) / max(len(t) - 5, 1)
    norm = np.linalg.norm(j, axis=0)
    scaled = j / np.where(norm > 0, norm, 1)
    cov = np.linalg.pinv(scaled.T @ scaled) / np.outer(np.where(norm > 0, norm, 1), np.where(norm > 0, norm, 1)) * max(1.0, chi2r)
    err = np.where((np.diag(cov) > 0) & (norm > 0), np.sqrt(np.maximum(np.diag(cov), 0)), np.nan)  # what the data do not constrain has none
    return {"tc": float(q[0]), "tc_err": float(err[0]), "t14_h": float(q[1] * 24), "t14_err": float(err[1] * 24), "depth": float(q[2]), "depth_err": float(err[2]),
            "ingress_frac": float(q[3]), "chi2_red": chi2r, "n_points": len(t), "converged": bool(done)}


def incompleteness(t: np.ndarray, tc: float, total: float, flags: str = "") -> dict:
    """Whether a dip is seen only in part, why, how long it is seen, and whether both its ends are; ``total`` in days.

    It is in part where its flags say so, where an end falls outside the night, or into a gap of more than twice the
    median spacing.  A gap in the middle is none.
    """
    why = [f"flag {x}" for x in ("EDGE", "PARTIAL") if x in (flags or "").split("|")]
    t = np.sort(t[np.isfinite(t)])
    ends, seen = [tc - total / 2, tc + total / 2], [True, True]
    if len(t):
        usual = float(np.median(np.diff(t))) if len(t) > 1 else 0.0
        for side, (name, beyond) in enumerate((("ingress", "before the first epoch"), ("egress", "after the last epoch"))):
            x = ends[side]
            if (x < t[0]) if side == 0 else (x > t[-1]):
                why.append(f"truncated: predicted {name} {beyond}")
                seen[side], ends[side] = False, float(t[0] if side == 0 else t[-1])
                continue
            k = int(np.searchsorted(t, x))
            if usual > 0 and 0 < k < len(t) and t[k - 1] < x < t[k] and t[k] - t[k - 1] > 2 * usual:
                why.append(f"gap covers {name}")
                seen[side], ends[side] = False, float(t[k] if side == 0 else t[k - 1])
        ends = [max(ends[0], float(t[0])), min(ends[1], float(t[-1]))]
    return {"t14_lower_limit": bool(why), "reason": "; ".join(why), "span_h": max(ends[1] - ends[0], 0.0) * 24, "ends_seen": all(seen)}


def standard(x: np.ndarray) -> np.ndarray:
    """A series about its median in units of its robust scatter, cut at five; zero where it has none."""
    x = x - np.median(x)
    s = 1.4826 * np.median(np.abs(x))
    return np.clip(x / s, -5, 5) if s > 0 else np.zeros(len(x))


def principal(gram: np.ndarray, most: int = 3, variance: float = 0.95) -> tuple[np.ndarray, np.ndarray]:
    """Principal components over frames (k, frames) from the sum of the stars' products of frames, and their shares of the variance.

    As many components as reach ``variance``, ``most`` at most; each one's largest value is positive.
    """
    value, vector = np.linalg.eigh(gram)
    value, vector = np.maximum(value[::-1], 0), vector[:, ::-1].T
    share = value / max(value.sum(), 1e-300)
    k = min(most, int(np.searchsorted(np.cumsum(share), variance)) + 1, len(value))
    v = vector[:k]
    sign = np.sign(v[np.arange(k), np.abs(v).argmax(axis=1)])
    return v * np.where(sign == 0, 1, sign)[:, None], share[:k]
