"""Joins on the sphere: within a radius, nearest, closest claimant, nearest other, cone."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lightloom.operators.regions import finite, unit_vector
from lightloom.session import cut


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Angle between two places by their chord, which is exact for small angles."""
    u, v = unit_vector(ra1, dec1), unit_vector(ra2, dec2)
    chord = F.sqrt(sum(((p - q) ** 2 for p, q in zip(u, v)), F.lit(0.0)))
    return F.degrees(2 * F.asin(F.least(chord / 2, F.lit(1.0)))) * 3600


def sky_join(left: DataFrame, right: DataFrame, arcsec: float, left_id: str, right_id: str, cell: float = 4.0) -> DataFrame:
    """(l_id, r_id, sep_arcsec) of all pairs at most ``arcsec`` apart; both tables have ra and dec in degrees.

    An equi-join on cells of a grid in space, see ``operators.regions``; rows without a place pair with nothing.
    """
    r = 2 * math.sin(math.radians(arcsec / 3600) / 2) * (1 + 1e-9) + 1e-15
    side, sides = cell * r, []
    for df, key, s in ((left, left_id, "l"), (right, right_id, "r")):
        ra, dec = F.col("ra").cast("double"), F.col("dec").cast("double")
        at = df.select(F.col(key).alias(f"{s}_id"), ra.alias("ra"), dec.alias("dec")).filter(finite(F.col("ra")) & finite(F.col("dec")))
        at = at.select(f"{s}_id", *(u.alias(f"{s}{n}") for n, u in zip("xyz", unit_vector(F.col("ra"), F.col("dec")))))
        for n in "xyz":
            u = F.col(f"{s}{n}")
            cells = F.explode(F.sequence(F.floor((u - r) / side), F.floor((u + r) / side))) if s == "l" else F.floor(u / side)
            at = at.withColumn(f"c{n}", cells)
        sides.append(at)
    chord = F.sqrt(sum(((F.col(f"l{n}") - F.col(f"r{n}")) ** 2 for n in "xyz"), F.lit(0.0)))
    sep = F.degrees(2 * F.asin(F.least(chord / 2, F.lit(1.0)))) * 3600
    return sides[0].join(sides[1], ["cx", "cy", "cz"]).select("l_id", "r_id", sep.alias("sep_arcsec")).filter(F.col("sep_arcsec") <= arcsec)


def nearest(pairs: DataFrame, by: str = "l_id") -> DataFrame:
    """The nearest partner of each row of one side (ties: the least id of the other)."""
    other = "r_id" if by == "l_id" else "l_id"
    best = F.min(F.struct("sep_arcsec", other)).alias("m")
    return pairs.groupBy(by).agg(best).select(by, F.col(f"m.{other}").alias(other), F.col("m.sep_arcsec").alias("sep_arcsec"))


def closest_wins(pairs: DataFrame) -> DataFrame:
    """Nearest partners of the left side, of which every right row keeps only the closest claimant."""
    return nearest(nearest(pairs, "l_id"), "r_id").select("l_id", "r_id", "sep_arcsec")


def isolated(points: DataFrame, arcsec: float, key: str) -> DataFrame:
    """Rows with no other row of the same table within the radius."""
    crowded = sky_join(points, points, arcsec, key, key).filter("l_id <> r_id").select(F.col("l_id").alias(key)).distinct()
    return points.join(crowded, key, "left_anti")


def nearest_other(points: DataFrame, key: str, start: float = 20.0, rings: int = 3) -> DataFrame:
    """(id, other, sep_arcsec): the nearest other row, looked for in ``rings`` widening radii (each four times the last).

    A row is asked again in the next ring only if it has found none, so the wide rings see few rows.  One that has none
    in the last ring gets no row; ``k_nearest`` has no such bound.
    """
    found, asked = None, points
    for k in range(rings):
        near = nearest(sky_join(asked, points, start * 4**k, key, key).filter("l_id <> r_id"))
        found = near if found is None else found.unionByName(near)
        asked = asked.join(near.select(F.col("l_id").alias(key)), key, "left_anti")
    return found.select(F.col("l_id").alias(key), F.col("r_id").alias("other"), "sep_arcsec")


def k_nearest(points: DataFrame, k: int, key: str, start: float = 20.0, few: int = 256) -> DataFrame:
    """(key, other, sep_arcsec, rank): the k nearest other rows, fewer only if the table has no more.

    They are looked for in widening radii (each four times the last).  A row that finds fewer than k goes on to the next
    ring; once at most ``few`` rows are open, or the radius covers half the sky, those are compared with all rows.
    """
    w = Window.partitionBy("l_id").orderBy("sep_arcsec", "r_id")
    points = points.filter(finite(F.col("ra")) & finite(F.col("dec")))
    out, asked, arcsec = None, points, start
    while arcsec < 90 * 3600 and (out is None or asked.count() > few):
        pairs = sky_join(asked, points, arcsec, key, key).filter("l_id <> r_id")
        ranked = cut(pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k))
        full = ranked.filter(F.col("rank") == k).select("l_id")
        kept = ranked.join(full, "l_id", "left_semi")
        out = kept if out is None else out.unionByName(kept)
        asked = cut(asked.join(full.select(F.col("l_id").alias(key)), key, "left_anti"))
        arcsec *= 4
    rest = farthest(asked, points, k, key).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return out.unionByName(rest).select(F.col("l_id").alias(key), F.col("r_id").alias("other"), "sep_arcsec", "rank")


def farthest(asked: DataFrame, points: DataFrame, k: int, key: str, block: int = 64) -> DataFrame:
    """(l_id, r_id, sep_arcsec): for each asked row the k nearest other points of each part of the points, at any distance.

    Blocks of asked rows meet the batches of every part of the points; of each part only k candidates a row go on.
    """
    kind = dict(points.dtypes)[key]
    rows = asked.select(F.struct(F.col(key).alias("id"), F.col("ra").cast("double").alias("ra"), F.col("dec").cast("double").alias("dec")).alias("p"))
    held = rows.withColumn("b", F.floor(F.monotonically_increasing_id() / block)).groupBy("b").agg(F.collect_list("p").alias("ps"))
    part = F.floor(F.monotonically_increasing_id() / 4096)
    other = points.select(F.struct(F.col(key).alias("id"), F.col("ra").cast("double").alias("ra"), F.col("dec").cast("double").alias("dec")).alias("q"), part.alias("part"))
    parts = other.groupBy("part").agg(F.collect_list("q").alias("qs"))

    def vectors(at: list) -> np.ndarray:
        ra, dec = np.radians([x["ra"] for x in at]), np.radians([x["dec"] for x in at])
        return np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for ps, qs in zip(batch["ps"], batch["qs"]):
                ids, others = np.array([x["id"] for x in ps]), np.array([x["id"] for x in qs])
                u, v = vectors(ps), vectors(qs)
                for i, one in enumerate(u):
                    chord = np.sqrt(((v - one) ** 2).sum(axis=1))
                    chord[others == ids[i]] = np.inf
                    near = np.lexsort((others, chord))[:k]
                    near = near[np.isfinite(chord[near])]
                    sep = np.degrees(2 * np.arcsin(np.minimum(chord[near] / 2, 1))) * 3600
                    yield pd.DataFrame({"l_id": ids[i], "r_id": others[near], "sep_arcsec": sep})

    return held.crossJoin(parts).mapInPandas(run, f"l_id {kind}, r_id {kind}, sep_arcsec double")


def cone(points: DataFrame, ra: float, dec: float, degrees: float) -> DataFrame:
    """Rows within a radius of a place; the band of declination reaches the scan as a pushed filter."""
    band = points.filter(F.col("dec").between(dec - degrees - 1e-9, dec + degrees + 1e-9))
    return band.filter(separation_arcsec(F.col("ra"), F.col("dec"), F.lit(ra), F.lit(dec)) <= degrees * 3600)


def gnomonic(ra: Column, dec: Column, ra0: Column | float, dec0: Column | float) -> tuple[Column, Column]:
    """Tangent-plane coordinates in degrees about a centre."""
    ra0, d0 = (F.radians(F.lit(x)) for x in (ra0, dec0))
    d, a = F.radians(dec), F.radians(ra) - ra0
    cos_c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    return F.degrees(F.cos(d) * F.sin(a) / cos_c), F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / cos_c)


def numbered_names(df: DataFrame, name: str, key: str) -> DataFrame:
    """Names made unique: the second of one name gets the suffix -2, and so on, in the order of ``key``."""
    w = Window.partitionBy(name).orderBy(key)
    return df.withColumn("rank", F.row_number().over(w)).withColumn(
        name, F.when(F.col("rank") > 1, F.concat(F.col(name), F.lit("-"), F.col("rank").cast("string"))).otherwise(F.col(name))
    ).drop("rank")
