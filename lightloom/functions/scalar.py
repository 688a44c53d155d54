"""Scalar functions as columns: magnitudes, sexagesimal text, bit masks, phases, probabilities."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Names of the bits of a detection's flags, in order.
FLAG_NAMES = ("EDGE", "TOO_DEEP", "FEW_POINTS", "HIGH_BETA", "PARTIAL", "STEP_LIKE", "APERTURE_INCONSISTENT", "SHARED_EPOCH")


def clean(x: Column) -> Column:
    """NaN and infinite as null: the store knows one kind of missing."""
    x = x.cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def magnitude(flux: Column, zero: float = 0.0) -> Column:
    return F.when(flux > 0, zero - 2.5 * F.log10(flux))


def magnitude_error(flux: Column, error: Column) -> Column:
    return F.when(flux > 0, 2.5 / math.log(10) * error / flux)


def flux_of(mag: Column) -> Column:
    return F.pow(F.lit(10.0), -0.4 * mag)


def _parts(value: Column, scale: int) -> tuple[Column, Column, Column]:
    """Whole, sixtieths and seconds * scale of a value, rounded once so that 60 never shows."""
    units = F.floor(value * 3600 * scale + 0.5)
    return F.floor(units / (3600 * scale)), F.pmod(F.floor(units / (60 * scale)), F.lit(60)), F.pmod(units, F.lit(60 * scale))


def ra_text(ra: Column) -> Column:
    """Right ascension in degrees as hhmmss.s."""
    h, m, s = _parts(F.pmod(ra, F.lit(360.0)) / 15, 10)
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(pad(F.pmod(h, F.lit(24))), pad(m), pad(F.floor(s / 10)), F.lit("."), F.pmod(s, F.lit(10)).cast("string"))


def dec_text(dec: Column) -> Column:
    """Declination in degrees as sddmmss."""
    d, m, s = _parts(F.abs(dec), 1)
    pad = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.when(dec < 0, "-").otherwise("+"), pad(d), pad(m), pad(s))


def object_name(ra: Column, dec: Column) -> Column:
    return F.concat(F.lit("RP J"), ra_text(ra), dec_text(dec))


def sexagesimal(text: Column) -> Column:
    """'[+-]d m s' in any of blanks, colons or letters as a number of the first unit; null if it is none."""
    part = F.transform(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:\.[0-9]*)?"), 0), lambda x: x.try_cast("double"))
    value = F.when(F.size(part) == 1, F.get(part, F.lit(0))).when(
        F.size(part) == 3, F.get(part, F.lit(0)) + F.get(part, F.lit(1)) / 60 + F.get(part, F.lit(2)) / 3600
    )
    return F.when(F.ltrim(text).startswith("-"), -value).otherwise(value)


def label_date(label: Column, otherwise: Column) -> Column:
    """The date at the head of a night's label (yyyymmdd), else another date."""
    head = F.regexp_extract(label, r"^(\d{8})(?:\D|$)", 1)
    return F.coalesce(F.try_to_timestamp(F.when(head != "", head), F.lit("yyyyMMdd")).cast("date"), otherwise.cast("date"))


def julian_date(at: Column, exposure_s: Column | None = None) -> Column:
    """Julian date (UTC) of a time, of mid-exposure if the exposure is given."""
    seconds = F.unix_micros(at) / 1e6 + (F.lit(0.0) if exposure_s is None else F.coalesce(exposure_s, F.lit(0.0)) / 2)
    return seconds / 86400 + 2440587.5


def flag_bits(text: Column) -> Column:
    """'A|B' as a bit mask; unknown names count as nothing."""
    tokens = F.split(F.coalesce(text, F.lit("")), r"\|")
    return sum((F.when(F.array_contains(tokens, n), 1 << k).otherwise(0) for k, n in enumerate(FLAG_NAMES)), F.lit(0))


def flag_text(bits: Column) -> Column:
    """A bit mask as 'A|B', in the order of the bits."""
    return F.array_join(F.array_compact(F.array(*(F.when(bits.bitwiseAND(1 << k) != 0, F.lit(n)) for k, n in enumerate(FLAG_NAMES)))), "|")


def has_token(text: Column, *tokens: str) -> Column:
    return F.coalesce(F.arrays_overlap(F.split(text, r"\|"), F.array(*map(F.lit, tokens))), F.lit(False))


def tier(bits: Column) -> Column:
    """3 for partial events, 2 for doubtful ones, else 1."""
    mask = {n: 1 << k for k, n in enumerate(FLAG_NAMES)}
    doubtful = mask["SHARED_EPOCH"] | mask["APERTURE_INCONSISTENT"] | mask["HIGH_BETA"]
    return F.when(bits.bitwiseAND(mask["PARTIAL"]) != 0, 3).when(bits.bitwiseAND(doubtful) != 0, 2).otherwise(1)


def any_keyword(types: Column, words: tuple[str, ...]) -> Column:
    """Whether any '|' token of a type contains any word, in any case."""
    return F.coalesce(F.exists(F.split(F.upper(types), r"\|"), lambda t: F.lit(False) if not words else sum((t.contains(w.upper()).cast("int") for w in words), F.lit(0)) > 0), F.lit(False))


def merge_tokens(*texts: Column) -> Column:
    """'A|B' texts as one, each token once, in order of appearance."""
    lists = [F.split(F.coalesce(t, F.lit("")), r"\|") for t in texts]
    return F.array_join(F.array_distinct(F.filter(F.concat(*lists), lambda x: x != "")), "|")


def phase(t: Column, t0: Column, period: Column, centred: bool = False) -> Column:
    """Phase in [0, 1), or in [-1/2, 1/2)."""
    half = 0.5 if centred else 0.0
    return F.pmod((t - t0) / period + half, F.lit(1.0)) - half


def commensurate(dt: Column, least: float, most: int = 50) -> Column:
    """dt / k for k = 1, 2, ... while it is at least ``least``, ``most`` of them at most."""
    n = F.least(F.floor(dt / least).cast("int"), F.lit(most))
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), lambda k: dt / k)).otherwise(F.array().cast("array<double>"))


def frequency_grid(lowest: Column, highest: Column, step: Column, most: int = 200_000) -> Column:
    """struct(fmin, df, n, coarsened): a uniform grid, its step widened where it would exceed ``most`` points."""
    n = F.floor((highest - lowest) / step).cast("long") + 1
    wide = n > most
    return F.struct(
        lowest.alias("fmin"), F.when(wide, (highest - lowest) / (most - 1)).otherwise(step).alias("df"),
        F.least(n, F.lit(most)).alias("n"), wide.alias("coarsened"),
    )


def harmonic_offset(period: Column, literature: Column) -> Column:
    """Least relative difference of a period to half, once and twice the literature's."""
    return F.array_min(F.array(*(F.abs(period / h - literature) / literature for h in (0.5, 1.0, 2.0))))


def trapezoid(t: Column, tc: Column, total: Column, ingress: Column) -> Column:
    """Relative depth, 0 to 1, of a trapezoid dip."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (total / 2 - F.abs(t - tc)) / ingress))


def chi2_sf_values(x: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Survival function of chi-squared for whole degrees of freedom, by the finite recurrences."""
    x, dof = np.maximum(np.asarray(x, float), 0), np.asarray(dof)
    out = np.full(len(x), np.nan)
    for k in np.unique(dof[np.isfinite(x) & (dof > 0)]):
        at = (dof == k) & np.isfinite(x)
        h = x[at] / 2
        if k % 2 == 0:
            term, total = np.exp(-h), np.exp(-h)
            for j in range(1, int(k) // 2):
                term = term * h / j
                total = total + term
        else:
            total = np.array([math.erfc(math.sqrt(v)) for v in h])
            term = np.sqrt(h / math.pi) * 2 * np.exp(-h)
            for j in range(int(k) // 2):
                total = total + term
                term = term * h / (j + 1.5)
        out[at] = np.clip(total, 0, 1)
    return out


@F.pandas_udf(DoubleType())
def chi2_sf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(chi2_sf_values(x.to_numpy(float), dof.fillna(0).to_numpy(int)))


def binomial_sf_values(k: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(at least k of n) for any k, as the regularised incomplete beta function I_p(k, n - k + 1) by its continued fraction.

    The fraction is taken on the side where it converges in about sqrt(n) steps; nan where an argument is missing.
    """
    k, n, p = (np.asarray(v, float) for v in (k, n, p))
    known = np.isfinite(k) & np.isfinite(n) & np.isfinite(p)
    p = np.clip(p, 0, 1)
    out = np.where(known, np.where(k <= 0, 1.0, np.where(k > n, 0.0, p)), np.nan)
    at = known & (k > 0) & (k <= n) & (p > 0) & (p < 1)
    if not at.any():
        return out
    a, b, x = k[at], n[at] - k[at] + 1, p[at]
    swap = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x)) / a
    away = lambda v: np.where(np.abs(v) < 1e-300, 1e-300, v)
    c, d = np.ones_like(x), 1 / away(1 - (a + b) * x / (a + 1))
    h = d.copy()
    for m in range(1, 100 + int(10 * math.sqrt(float(np.max(a + b))))):
        even, odd = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d, c = 1 / away(1 + term * d), away(1 + term / c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    out[at] = np.clip(np.where(swap, 1 - front * h, front * h), 0, 1)
    return out


@F.pandas_udf(DoubleType())
def binomial_sf(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series(binomial_sf_values(k.to_numpy(float), n.to_numpy(float), p.to_numpy(float)))
