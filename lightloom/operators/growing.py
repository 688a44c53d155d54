"""Cross-matching where the list to match against grows: frames within a night, nights within a set; and detector borders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lightloom.operators import robust as R
from lightloom.operators.regions import finite


def _vectors(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    a, d = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)


def closest(ra: np.ndarray, dec: np.ndarray, to_ra: np.ndarray, to_dec: np.ndarray, arcsec: float) -> np.ndarray:
    """Index of each place's match in the second list, -1 for none; of several claimants of one match the closest has it.

    Candidates come from a window of the second list in order of declination.
    """
    out = np.full(len(ra), -1)
    if not len(to_ra) or not len(ra):
        return out
    order = np.argsort(to_dec, kind="stable")
    band = arcsec / 3600 * (1 + 1e-9)
    i, j = np.searchsorted(to_dec[order], dec - band, "left"), np.searchsorted(to_dec[order], dec + band, "right")
    n = j - i
    src = np.repeat(np.arange(len(ra)), n)
    cand = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(i, n)]
    chord = np.linalg.norm(_vectors(ra, dec)[src] - _vectors(to_ra, to_dec)[cand], axis=1)
    near = chord <= 2 * np.sin(np.radians(arcsec / 3600) / 2) * (1 + 1e-12)
    src, cand, chord = src[near], cand[near], chord[near]
    first = np.lexsort((cand, chord, src))
    first = first[np.append(True, np.diff(src[first]) != 0)] if len(first) else first  # nearest of each source
    src, cand, chord = src[first], cand[first], chord[first]
    best = np.lexsort((src, chord, cand))
    best = best[np.append(True, np.diff(cand[best]) != 0)] if len(best) else best  # closest claimant of each
    out[src[best]] = cand[best]
    return out


def match_frames(sources: DataFrame, arcsec: float = 1.0, presence: float = 0.0) -> DataFrame:
    """(night_id, frame_index, source, star): sources of a night's frames, in order, against a master list that grows.

    A source that matches no star of the frames before becomes a new one.  The order makes a night one sequential
    task; nights, of which each holds a telescope's one night of exposures, run side by side.  ``presence`` keeps stars
    that are in at least this share of the frames.
    """

    def grouped(g: pd.DataFrame) -> pd.DataFrame:
        g = g[np.isfinite(g["ra"]) & np.isfinite(g["dec"])].sort_values(["frame_index", "source"], kind="stable")
        ra, dec, out = np.zeros(0), np.zeros(0), []
        for _, frame in g.groupby("frame_index", sort=True):
            a, d = frame["ra"].to_numpy(float), frame["dec"].to_numpy(float)
            star = closest(a, d, ra, dec, arcsec)
            new = star < 0
            star[new] = len(ra) + np.arange(new.sum())
            ra, dec = np.concatenate([ra, a[new]]), np.concatenate([dec, d[new]])
            out.append(frame[["night_id", "frame_index", "source"]].assign(star=star))
        return pd.concat(out) if out else g[["night_id", "frame_index", "source"]].assign(star=0)

    matched = sources.select("night_id", "frame_index", "source", "ra", "dec").groupBy("night_id").applyInPandas(
        grouped, "night_id int, frame_index int, source long, star long"
    )
    if presence <= 0:
        return matched
    frames = sources.groupBy("night_id").agg(F.countDistinct("frame_index").alias("n"))
    seen = matched.groupBy("night_id", "star").agg(F.count("*").alias("k")).join(frames, "night_id").filter(F.col("k") >= presence * F.col("n"))
    return matched.join(seen.select("night_id", "star"), ["night_id", "star"], "left_semi")


def match_sets(stars: DataFrame, arcsec: float = 1.0) -> DataFrame:
    """(set, night_id, star, global): stars of every set's nights, in order of ``step``, against the set's list that grows.

    ``stars``: set, step, night_id, star, ra, dec; the night of the least step is the anchor.  A star that matches none of
    the nights before becomes a new one, numbered on within its set.  Sets do not meet (small ones may share a task); rows come sorted, so a
    task holds one night and the list of one set, however many nights there are.
    """

    def nights(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # a night may go over several batches
        for batch in batches:
            new = batch["set"].ne(batch["set"].shift()) | batch["step"].ne(batch["step"].shift())
            for _, part in batch.groupby(new.cumsum(), sort=False):
                if held and (held[0]["set"].iloc[0], held[0]["step"].iloc[0]) != (part["set"].iloc[0], part["step"].iloc[0]):
                    yield pd.concat(held)
                    held = []
                held.append(part)
        if held:
            yield pd.concat(held)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, ra, dec = None, np.zeros(0), np.zeros(0)
        for night in nights(batches):
            if night["set"].iloc[0] != at:
                at, ra, dec = night["set"].iloc[0], np.zeros(0), np.zeros(0)
            a, d = night["ra"].to_numpy(float), night["dec"].to_numpy(float)
            star = closest(a, d, ra, dec, arcsec)
            new = star < 0
            star[new] = len(ra) + np.arange(new.sum())
            ra, dec = np.concatenate([ra, a[new]]), np.concatenate([dec, d[new]])
            yield night[["set", "night_id", "star"]].assign(**{"global": star})

    kinds = dict(stars.dtypes)
    placed = stars.select("set", "step", "night_id", "star", F.col("ra").cast("double"), F.col("dec").cast("double")).dropna()
    placed = placed.filter(finite(F.col("ra")) & finite(F.col("dec")))
    ordered = placed.repartition("set").sortWithinPartitions("set", "step", "night_id", "star")
    return ordered.mapInPandas(run, f"set {kinds['set']}, night_id {kinds['night_id']}, star {kinds['star']}, global long")


def match_nights(stars: DataFrame, nights: list[int], arcsec: float = 1.0) -> DataFrame:
    """(night_id, star, global): stars of several nights, the anchor first, against one list that grows by night."""
    step = F.array_position(F.array(*map(F.lit, nights)), F.col("night_id"))
    ordered = stars.withColumns({"set": F.lit(0), "step": step}).filter("step > 0")
    return match_sets(ordered, arcsec).select("night_id", "star", "global")


def frame_offsets(places: DataFrame, reference: DataFrame, least: int = 20) -> DataFrame:
    """(night_id, frame_index, dx, dy): median shift of each frame from reference places of at least ``least`` common stars."""
    both = places.join(reference.select("star", F.col("x").alias("x0"), F.col("y").alias("y0")), "star")
    out = both.groupBy("night_id", "frame_index").agg(R.median(F.col("x") - F.col("x0")).alias("dx"), R.median(F.col("y") - F.col("y0")).alias("dy"), F.count("*").alias("n"))
    return out.filter(F.col("n") >= least).drop("n")


def inside_borders(reference: DataFrame, offsets: DataFrame, width: float, height: float, margin: float = 30.0) -> DataFrame:
    """(night_id, star, inside): whether a star (night_id, star, x, y) stays off the detector's borders in every frame of its night.

    Shifts are the same for all stars, so the extremes of a night's shifts decide: one row per night meets the stars.
    """
    span = offsets.groupBy("night_id").agg(F.min("dx").alias("x0"), F.max("dx").alias("x1"), F.min("dy").alias("y0"), F.max("dy").alias("y1"))
    both = reference.join(span, "night_id")
    x, y = F.col("x"), F.col("y")
    ok = (x + F.col("x0") >= margin) & (x + F.col("x1") <= width - margin) & (y + F.col("y0") >= margin) & (y + F.col("y1") <= height - margin)
    return both.select("night_id", "star", ok.alias("inside"))
