"""Implausible readings of a measured series: spikes, stuck values, impossible values.

Method: a hidden Markov model per series whose emissions are of four kinds: normal, spike, stuck and out-of-range.
They depend on the reading's distance from the series' local level in units of that series' own scatter, on whether the
value repeats the one before, and on whether it breaks a hard bound.  Durations are part of the model: a spike has one to three
states in a row and must end in a normal one, a stuck run at least five, and a longer change of level (which is
normal) at least four.  The forward-backward probabilities assign the flags: a reading is stuck or of a spike
where that kind's posterior exceeds ``posterior``, and hard bounds assign out-of-range.  A group of readings with a
spike's posterior is then held to the definition, distance from the readings on both sides.

A change that the other series of the same night show in the same frame (cloud) is divided out first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lightloom.session import cut

NORMAL, SPIKE, STUCK, RANGE = range(4)
#: Least scatter relative to a series' median: readings are stored in single precision.
RESOLUTION = 1e-6


@dataclass(frozen=True)
class SpikeModel:
    """Parameters of the model; the defaults are the production values."""

    apart: float = 10.0  #: distance of a spike from both sides, in scatters
    ramp: float = 5.0  #: least distance from the very next readings, so that slopes of longer changes are none
    group: int = 3  #: most readings of a spike
    run: int = 5  #: least readings of a stuck run
    half: int = 4  #: half width of the local level's running median
    least: int = 8  #: readings a series needs for a scatter
    peers: int = 5  #: series a frame needs for its common factor
    chunk: int = 1024  #: frames of a series that one row holds
    overlap: int = 64  #: frames of the neighbouring chunks that are seen as well
    ranks: int = 100_000  #: accuracy of the scatter of a series of more than one chunk, in ranks
    posterior: float = 0.5  #: probability of a kind that assigns it
    tails: float = 6.0  #: degrees of freedom of the normal emission
    starts: tuple[float, float, float] = (0.02, 0.005, 0.005)  #: probability that a spike, longer change, stuck run begins
    goes_on: float = 0.3  #: probability that a spike has one more reading
    lasts: tuple[float, float] = (0.85, 0.9)  #: probability that a longer change, a stuck run goes on past its least length
    repeats: float = 0.02  #: probability that a reading which is not stuck repeats the one before


FOUND = "field string, night_id int, star_id bigint, frame_index int, aper int"


@dataclass(frozen=True)
class Chain:
    """The model's states: one of normal, ``group`` of a spike, ``group`` + 1 of a longer change, ``run`` of a stuck run."""

    move: np.ndarray
    first: np.ndarray
    last: np.ndarray
    spike: slice
    change: slice
    stuck: slice

    @classmethod
    def of(cls, m: SpikeModel) -> Chain:
        spike = slice(1, 1 + m.group)
        change = slice(spike.stop, spike.stop + m.group + 1)
        stuck = slice(change.stop, change.stop + m.run)
        n = stuck.stop
        begin = np.zeros(n)
        begin[[spike.start, change.start, stuck.start]] = m.starts
        a = np.zeros((n, n))
        a[0] = begin
        a[0, 0] = 1 - begin.sum()
        leave = begin / begin.sum() * 0.1  # what follows at once on something else
        leave[0] = 0.9
        after = leave.copy()
        after[spike.start] = 0  # a spike ends before the next one begins
        after /= after.sum()
        for k in range(spike.start, spike.stop):
            on = m.goes_on if k + 1 < spike.stop else 0.0
            a[k] = (1 - on) * after
            if on:
                a[k, k + 1] += on
        for part, stays in ((change, m.lasts[0]), (stuck, m.lasts[1])):
            for k in range(part.start, part.stop - 1):
                a[k, k + 1] = 1
            a[part.stop - 1] = (1 - stays) * leave
            a[part.stop - 1, part.stop - 1] += stays
        first, last = np.zeros(n), np.ones(n)
        first[[0, change.stop - 1, stuck.start]] = 0.95, 0.03, 0.02  # a change may have begun before
        last[spike] = 0  # a spike has readings on both sides
        last[stuck.start : stuck.stop - 1] = 0  # a stuck run is whole
        return cls(a, first, last, spike, change, stuck)


def local_level(x: np.ndarray, half: int) -> np.ndarray:
    """Running median along the last axis; ends continue by reflection in the end point, which keeps a trend."""
    h = min(half, x.shape[1] - 1)
    head, tail = 2 * x[:, :1] - x[:, h:0:-1], 2 * x[:, -1:] - x[:, -2 : -h - 2 : -1]
    wide = np.lib.stride_tricks.sliding_window_view(np.concatenate([head, x, tail], axis=1), 2 * h + 1, axis=1)
    return np.partition(wide, h, axis=2)[:, :, h]


def scatter(x: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Usual scatter of each row: MAD of successive differences / sqrt 2, over pairs that differ at all."""
    d = np.where(moved, np.diff(x, axis=1), np.nan)
    with np.errstate(all="ignore"):
        import warnings

        with warnings.catch_warnings():
            warnings.simplefilter("ignore", RuntimeWarning)
            s = 1.4826 / np.sqrt(2) * np.nanmedian(np.abs(d - np.nanmedian(d, axis=1, keepdims=True)), axis=1)
    return np.maximum(np.nan_to_num(s, nan=np.inf), RESOLUTION * np.abs(np.median(x, axis=1)) + 1e-300)


def posteriors(z: np.ndarray, linked: np.ndarray, broken: np.ndarray, m: SpikeModel) -> np.ndarray:
    """Forward-backward probabilities (rows, time, kind) of equally long series; ``linked`` tells whether a reading repeats the one before.

    An out-of-range reading is known by its bound and says nothing of the others: the chain passes over it.
    """
    c, (rows, n) = Chain.of(m), z.shape
    a = np.abs(z)
    usual = 0.4 * (1 + a * a / m.tails) ** (-(m.tails + 1) / 2)
    broad = 1 / (2 * np.maximum(a, 5) * np.log(1e5 / 5))  # any far level is as likely on a scale of ratios
    other = np.where(linked, m.repeats, 1 - m.repeats)
    again, fresh = np.where(linked, 0.98, 1e-9), np.where(linked, 1e-6, 0.98)
    p = np.empty((rows, n, len(c.move)))
    p[:, :, 0] = usual * other
    p[:, :, c.spike] = (np.where(a > 5, broad, 1e-6) * other)[:, :, None]
    p[:, :, c.change] = (broad * np.clip((a / 5) ** 2, 0.1, 1) * other)[:, :, None]
    any_level = 0.5 * usual + 0.5 * broad
    p[:, :, c.stuck] = (any_level * again)[:, :, None]
    p[:, :, c.stuck.start] = any_level * fresh
    ahead, back = np.empty_like(p), np.empty_like(p)
    start = np.ones(rows, bool)  # nothing but out-of-range readings so far
    f = np.tile(c.first, (rows, 1))
    for t in range(n):
        new = np.where(start[:, None], f, f @ c.move) * p[:, t]
        total = new.sum(axis=1, keepdims=True)
        new = np.where(total > 0, new / np.where(total > 0, total, 1), c.first)
        f = np.where(broken[:, t, None], f, new)
        start &= broken[:, t]
        ahead[:, t] = f
    b = np.tile(c.last, (rows, 1))
    for t in range(n - 1, -1, -1):
        back[:, t] = b
        new = (b * p[:, t]) @ c.move.T
        total = new.sum(axis=1, keepdims=True)
        b = np.where(broken[:, t, None], b, new / np.where(total > 0, total, 1))
    g = ahead * back
    total = g.sum(axis=2)
    out = np.zeros((rows, n, 4))
    share = np.where(total > 0, 1 / np.where(total > 0, total, 1), 0)
    out[:, :, SPIKE] = g[:, :, c.spike].sum(axis=2) * share
    out[:, :, STUCK] = g[:, :, c.stuck].sum(axis=2) * share
    out[:, :, NORMAL] = 1 - out[:, :, SPIKE] - out[:, :, STUCK]
    out[broken] = (0, 0, 0, 1)
    return out


def prepared(raw: np.ndarray, common: np.ndarray, broken: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Series without their common factor, whether each reading repeats the one before, and which steps tell of the scatter."""
    n = raw.shape[1]
    linked = np.zeros_like(broken)
    linked[:, 1:] = (raw[:, 1:] == raw[:, :-1]) & ~broken[:, 1:]
    # Impossible values take no part in level and scatter: the reading before (else after) stands in.
    with np.errstate(all="ignore"):
        x = np.where(broken, np.nan, raw / common)
    if broken.any():
        before = np.maximum.accumulate(np.where(broken, -1, np.arange(n)), axis=1)
        after = np.minimum.accumulate(np.where(broken, n, np.arange(n))[:, ::-1], axis=1)[:, ::-1]
        x = np.take_along_axis(x, np.clip(np.where(before >= 0, before, after), 0, n - 1), axis=1)
        x[broken.all(axis=1)] = 0
    return x, linked, ~linked[:, 1:] & ~broken[:, 1:] & ~broken[:, :-1]


def judge(raw: np.ndarray, common: np.ndarray, broken: np.ndarray, m: SpikeModel, known: np.ndarray | None = None) -> np.ndarray:
    """Flags of equally long series (rows, time); ``common`` holds the factors to divide out, ``known`` scatters where the series has more chunks."""
    flagged = broken.copy()
    n = raw.shape[1]
    if n < 2:
        return flagged
    x, linked, moved = prepared(raw, common, broken)
    s = scatter(x, moved)
    if known is not None:
        s = np.where(np.isnan(known), s, np.maximum(known, RESOLUTION * np.abs(np.median(x, axis=1)) + 1e-300))
    enough = n >= m.least
    z = (x - local_level(x, m.half)) / s[:, None] if enough else np.zeros_like(x)
    if enough:
        # Once more with far readings bridged, so that a group does not shift its neighbours' level.
        far = np.abs(z) > m.apart
        for r in np.flatnonzero(far.any(axis=1) & ~far.all(axis=1)):
            near = np.flatnonzero(~far[r])
            bridged = np.interp(np.arange(n), near, x[r, near])[None]
            z[r] = (x[r] - local_level(bridged, m.half)[0]) / s[r]
    kinds = posteriors(z, linked, broken, m)
    flagged |= kinds[:, :, STUCK] > m.posterior
    spike = kinds[:, :, SPIKE] > m.posterior
    for r in np.flatnonzero(spike.any(axis=1)):
        keep = np.flatnonzero(~broken[r])
        v = x[r, keep]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], spike[r, keep], [False]]).astype(np.int8)))
        for i, j in zip(edge[::2], edge[1::2]):
            if i == 0 or j == len(v):
                continue
            sides = np.array([np.median(v[max(0, i - 3) : i]), np.median(v[j : j + 3])])
            nearest = np.array([v[i - 1], v[j]])
            far = np.abs(v[i:j, None] - sides).min() > m.apart * s[r]
            if far and np.abs(v[i:j, None] - nearest).min() > m.ramp * s[r]:
                flagged[r, keep[i:j]] = True
    return flagged


@dataclass(frozen=True)
class Quantity:
    """A measured quantity: the bound that no real reading passes, and whether its series share a frame's common factor."""

    name: str
    bound: float
    included: bool = False  #: whether the bound itself is possible
    common: bool = False

    def impossible(self, x: np.ndarray) -> np.ndarray:
        return np.isinf(x) | ((x < self.bound) if self.included else (x <= self.bound))


PHOTOMETRY = (Quantity("flux", 0.0, common=True), Quantity("fwhm", 0.0), Quantity("airmass", 1.0, included=True))


def _series(batch: pa.RecordBatch) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    """A batch's columns by name, and its readings in order of series and frame: offsets, frames, values."""
    col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
    offset = np.asarray(col["r"].offsets)
    frame, value = (np.asarray(x)[offset[0] : offset[-1]] for x in col["r"].values.flatten())
    offset = offset - offset[0]
    order = np.lexsort((frame, np.repeat(np.arange(len(offset) - 1), np.diff(offset))))
    return col, offset, frame[order], value[order]


def _impossible(col: dict, series: np.ndarray, value: np.ndarray, quantities: tuple[Quantity, ...]) -> np.ndarray:
    kind = np.asarray(col["kind"])[series]
    bad = np.zeros(len(value), bool)
    for k, q in enumerate(quantities):
        own = kind == k
        bad[own] = q.impossible(value[own])
    return bad


def _ratios(quantities: tuple[Quantity, ...]):
    """Kernel: the readings of series that share a common factor, relative to their own median."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col, offset, frame, value = _series(batch)
            length = np.diff(offset)
            series = np.repeat(np.arange(len(length)), length)
            shared = np.array([q.common for q in quantities])[np.asarray(col["kind"])]
            use = shared[series] & ~_impossible(col, series, value, quantities) & (value > 0)
            series, frame, value = series[use], frame[use], value[use]
            order = np.lexsort((value, series))
            count = np.bincount(series, minlength=len(length))
            start = np.cumsum(count) - count
            some = count > 0
            level = np.ones(len(length))
            level[some] = value[order][start[some] + count[some] // 2]
            row = pa.array(series)
            columns = [col["kind"].take(row), col["night_id"].take(row), col["chunk"].take(row), pa.array(frame, pa.int32()), pa.array(value / level[series])]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "night_id", "chunk", "frame_index", "ratio"])

    return run


def _relative(col: dict, offset: np.ndarray, frame: np.ndarray) -> np.ndarray:
    """The common factor of every reading, 1 where its frame has none."""
    common = np.ones(len(frame))
    factor_at = np.asarray(col["peers"].offsets)
    factor_frame, factor = (np.asarray(x) for x in col["peers"].values.flatten())
    for r in np.flatnonzero(np.diff(factor_at)):
        known, factors = (x[factor_at[r] : factor_at[r + 1]] for x in (factor_frame, factor))
        order = np.argsort(known)
        known, factors = known[order], factors[order]
        at = slice(offset[r], offset[r + 1])
        k = np.minimum(np.searchsorted(known, frame[at]), len(known) - 1)
        common[at] = np.where(known[k] == frame[at], factors[k], 1.0)
    return common


def _steps(m: SpikeModel, quantities: tuple[Quantity, ...]):
    """Kernel: the successive differences of every series that tell of its scatter, each from the chunk of its later reading."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col, offset, frame, value = _series(batch)
            series = np.repeat(np.arange(len(offset) - 1), np.diff(offset))
            impossible, common = _impossible(col, series, value, quantities), _relative(col, offset, frame)
            rows, steps = [], []
            for r in range(len(offset) - 1):
                at = slice(offset[r], offset[r + 1])
                if at.stop - at.start < 2:
                    continue
                x, _, moved = prepared(value[at][None], common[at][None], impossible[at][None])
                own = np.floor_divide(frame[at][1:], m.chunk) == col["chunk"][r].as_py()
                d = np.diff(x[0])[own & moved[0]]
                rows.append(np.full(len(d), r))
                steps.append(d)
            row = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            names = ["kind", "night_id", "star_id", "aper"]
            yield pa.RecordBatch.from_arrays([*(col[n].take(row) for n in names), pa.array(np.concatenate(steps) if steps else np.zeros(0))], names=[*names, "d"])

    return run


def _kernel(m: SpikeModel, quantities: tuple[Quantity, ...]):
    names = pa.array([q.name for q in quantities])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col, offset, frame, value = _series(batch)
            length = np.diff(offset)
            series = np.repeat(np.arange(len(length)), length)
            impossible, common = _impossible(col, series, value, quantities), _relative(col, offset, frame)
            known = np.asarray(col["scatter"], dtype=float)
            hit = np.zeros(len(value), bool)
            for n in np.unique(length[length > 0]):
                rows = np.flatnonzero(length == n)
                for part in np.array_split(rows, max(1, len(rows) * int(n) // 100_000)):
                    at = offset[part][:, None] + np.arange(n)
                    hit[at] = judge(value[at], common[at], impossible[at], m, known[part])
            own = np.floor_divide(frame, m.chunk) == np.asarray(col["chunk"])[series]
            found = np.flatnonzero(hit & own)
            row = pa.array(series[found])
            columns = [names.take(col["kind"].take(row)), *(col[n].take(row) for n in ("night_id", "star_id")), pa.array(frame[found], pa.int32()), col["aper"].take(row)]
            yield pa.RecordBatch.from_arrays(columns, names=["field", "night_id", "star_id", "frame_index", "aper"])

    return run


def readings(
    df: DataFrame, kind: int, night: Column, star: Column, aper: Column, frame: Column, value: Column, order: Column
) -> DataFrame:
    """One measured quantity as long rows; missing values stay, for the last loaded row of a key counts."""
    return df.select(
        F.lit(kind).alias("kind"), night.cast("int").alias("night_id"), star.cast("long").alias("star_id"),
        aper.cast("int").alias("aper"), frame.cast("int").alias("frame_index"), order.cast("long").alias("ord"),
        value.cast("double").alias("value"),
    )


def _grouped(usable: DataFrame, quantities: tuple[Quantity, ...], m: SpikeModel) -> DataFrame:
    """One row per series and chunk: its readings, and the common factors of its night's frames."""
    key, at = ["kind", "night_id", "star_id", "aper"], ["kind", "night_id", "chunk"]
    last = (
        usable.groupBy(*key, "frame_index")
        .agg(F.max(F.struct("ord", "value")).alias("last"))
        .select(*key, "frame_index", F.col("last.value").alias("value"))
        .filter("value is not null and not isnan(value)")
    )
    f = F.col("frame_index")
    seen = (F.when(f >= 0, F.greatest(f - m.overlap, F.lit(0))).otherwise(f - m.overlap), f, f + m.overlap)
    places = F.array_distinct(F.array(*(F.floor(x / m.chunk).cast("int") for x in seen)))
    series = (
        last.withColumn("chunk", F.explode(places))
        .repartition(*key, "chunk")
        .groupBy(*key, "chunk")
        .agg(F.collect_list(F.struct("frame_index", "value")).alias("r"))
    )
    # One frame of one night is the largest group here; its rows meet unsorted, and the sketch is bounded.
    peers = (
        series.mapInArrow(_ratios(quantities), "kind int, night_id int, chunk int, frame_index int, ratio double")
        .repartition(*at, "frame_index")
        .groupBy(*at, "frame_index")
        .agg(F.count("*").alias("n"), F.percentile_approx("ratio", 0.5, 1000).alias("factor"))
        .filter(f"n >= {m.peers} and factor > 0")
        .groupBy(*at)
        .agg(F.collect_list(F.struct("frame_index", "factor")).alias("peers"))
    )
    none = F.array().cast("array<struct<frame_index:int,factor:double>>")
    return series.join(peers, at, "left").select(*key, "chunk", "r", F.coalesce("peers", none).alias("peers"))


def implausible(readings: DataFrame, quantities: tuple[Quantity, ...] = PHOTOMETRY, m: SpikeModel = SpikeModel()) -> DataFrame:
    """Rows (field, night_id, star_id, frame_index, aper) of readings that cannot be real.

    ``readings``: see ``readings``; ``kind`` counts in ``quantities``.  Of several rows of a key the one with the
    greatest ``ord`` counts (ties: the greatest value); nulls and NaN are left out after that, rows with a null key
    or frame before.  A series may be of any length: it is judged in chunks of frames that see their
    neighbours, with the scatter of the whole series, so no task holds more than a chunk of one series, and the rows of
    a key are combined before the first shuffle.  Series shorter than ``m.least`` have no scatter: only impossible and
    stuck readings are found there.
    """
    key, night = ["kind", "night_id", "star_id", "aper"], ["kind", "night_id"]
    usable = readings.dropna(subset=[*key, "frame_index"])
    # Nights of more than one chunk, where a series' scatter has to be put together; in all others a row has all of it.
    of = F.floor(F.col("frame_index") / m.chunk)
    long = usable.groupBy(*night).agg(F.min(of).alias("a"), F.max(of).alias("b")).filter("a < b").select(*night)
    if long.isEmpty():
        return _grouped(usable, quantities, m).withColumn("scatter", F.lit(None).cast("double")).mapInArrow(_kernel(m, quantities), FOUND)
    long = cut(long)
    whole = _grouped(usable.join(long, night, "left_anti"), quantities, m).withColumn("scatter", F.lit(None).cast("double"))
    parts = cut(_grouped(usable.join(long, night, "left_semi"), quantities, m))
    steps = parts.mapInArrow(_steps(m, quantities), "kind int, night_id int, star_id bigint, aper int, d double")
    middle = steps.groupBy(*key).agg(F.percentile_approx("d", 0.5, m.ranks).alias("m"))
    off = steps.join(middle, key).groupBy(*key).agg(F.percentile_approx(F.abs(F.col("d") - F.col("m")), 0.5, m.ranks).alias("mad"))
    parts = parts.join(off.select(*key, (F.col("mad") * (1.4826 / np.sqrt(2))).alias("scatter")), key, "left")
    return whole.unionByName(parts).mapInArrow(_kernel(m, quantities), FOUND)


def implausible_photometry(epochs: DataFrame, frames: DataFrame, m: SpikeModel = SpikeModel()) -> DataFrame:
    """The flux of ``epochs`` and the fwhm and airmass of ``frames``, judged together; see ``implausible``."""
    c, none = F.col, F.lit(-1)
    loaded = F.unix_micros(c("loaded_at").cast("timestamp"))
    flux = readings(epochs, 0, c("night_id"), c("star_id"), c("aper"), c("frame_index"), c("flux"), loaded)
    for kind, name in ((1, "fwhm"), (2, "airmass")):
        flux = flux.unionByName(readings(frames, kind, c("night_id"), none, none, c("frame_index"), c(name), c("frame_id")))
    return implausible(flux, m=m)
