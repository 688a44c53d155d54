"""Points near other points, and the regions that contain a point, on the sphere.

Everything is an outline in a plane.  A region becomes a polygon in the plane of right ascension and declination that contains
it (circles: steps of declination bands, so that caps over a pole and outlines through 0 h need no special case); the
neighbourhood of a point becomes a square that contains it on a face of the cube around the sphere (no pole and no
seam of the coordinates exists there).  Polygons are triangulated by ear clipping, and the triangles are distributed
through a bounding-volume hierarchy: a quadtree of boxes over the plane, in which a triangle belongs to the few nodes that
it meets on the level whose boxes are about its own size.  Points descend through the levels that hold triangles.

Triangles and points are both rows and meet by an equi-join on the node, so nothing is sent whole to a worker; Spark
broadcasts one side only where it has measured it to be small.  Candidate triangles are tested exactly, then the
outline itself (angular distance, box limits), and what a point on the shared border of several triangles of one outline
is assigned is made one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Borders belong to a region; coordinates in degrees are equal within this.
BORDER = 1e-9


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))


def clip_ears(ring: np.ndarray) -> np.ndarray:
    """Triangles (n - 2, 3, 2) of a simple polygon (n, 2) of either orientation; flat ears are dropped."""
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    x, y = ring[:, 0], ring[:, 1]
    rest = list(range(len(ring)))
    if np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y) < 0:
        rest.reverse()
    out = []
    while len(rest) > 3:
        for k in range(len(rest)):
            a, b, c = (ring[rest[(k + d) % len(rest)]] for d in (-1, 0, 1))
            area = turn(a, b, c)
            if area < 0:
                continue
            others = ring[[r for i, r in enumerate(rest) if (i - k) % len(rest) not in (0, 1, len(rest) - 1)]]
            inside = (turn(a, b, others.T) >= 0) & (turn(b, c, others.T) >= 0) & (turn(c, a, others.T) >= 0)
            corner = (others == a).all(1) | (others == b).all(1) | (others == c).all(1)
            if area == 0 or not (inside & ~corner).any():
                if area > 0:
                    out.append((a, b, c))
                rest.pop(k)
                break
        else:
            raise ValueError("the outline crosses itself")
    if turn(*(ring[r] for r in rest)) > 0:
        out.append(tuple(ring[r] for r in rest))
    return np.array(out).reshape(-1, 3, 2)


def circle_outline(ra: float, dec: float, radius: float, bands: int = 24) -> np.ndarray:
    """A polygon (n, 2) that contains the circle: for each band of declination the greatest half width in it."""
    lo, hi = max(-90.0, dec - radius), min(90.0, dec + radius)
    edge = np.linspace(lo, hi, bands + 1)
    d0, r = np.radians(dec), np.radians(radius)

    def half(d: np.ndarray) -> np.ndarray:
        d = np.radians(d)
        with np.errstate(all="ignore"):
            c = (np.cos(r) - np.sin(d) * np.sin(d0)) / (np.cos(d) * np.cos(d0))
        c = np.where(np.isfinite(c), c, -1.0)
        return np.degrees(np.arccos(np.clip(c, -1, 1)))

    width = np.maximum(half(edge[:-1]), half(edge[1:]))
    if abs(dec) + radius >= 90:  # over a pole: the bands round it are whole rings
        pole = 90.0 if dec >= 0 else -90.0
        ring = np.abs(pole - edge) <= radius - (90 - abs(dec)) + 1e-9
        width = np.where(ring[:-1] | ring[1:], 180.0, width)
    if abs(np.sin(d0)) < np.cos(r):
        widest = np.degrees(np.arcsin(np.sin(d0) / np.cos(r)))
        k = np.clip(np.searchsorted(edge, widest) - 1, 0, bands - 1)
        width[k] = max(width[k], np.degrees(np.arcsin(min(1.0, np.sin(r) / max(np.cos(d0), 1e-12)))))
    width, pad = width + 1e-7, 1e-7
    low, high = edge[:-1].copy(), edge[1:].copy()
    low[0], high[-1] = low[0] - pad, high[-1] + pad
    west = np.stack([np.repeat(ra - width, 2), np.stack([low, high], 1).ravel()], 1)
    east = np.stack([np.repeat(ra + width, 2), np.stack([low, high], 1).ravel()], 1)[::-1]
    ring = np.concatenate([west, east])
    return ring[np.append(True, (np.diff(ring, axis=0) != 0).any(1))]


def box_outline(ra_from: float, ra_to: float, dec_from: float, dec_to: float) -> np.ndarray:
    """The box that runs eastwards from ra_from to ra_to, a little widened, as a polygon."""
    width = (ra_to - ra_from) % 360.0
    if width == 0 and ra_to != ra_from:
        width = 360.0
    a, b, c, d = ra_from - 1e-7, ra_from + width + 1e-7, dec_from - 1e-7, dec_to + 1e-7
    return np.array([[a, c], [b, c], [b, d], [a, d]])


#: Deepest level of the quadtree; triangles too small for it stay on it.
DEEPEST = 30
CORNERS = ("ax", "ay", "bx", "by", "cx", "cy")


def _side(level: Column, width: float) -> Column:
    return width / F.pow(F.lit(2.0), level)


def nodes_of_triangles(triangles: DataFrame, width: float, parts: int) -> DataFrame:
    """``triangles`` (chart, the corners, more) with the nodes (level, i, j) that each meets; a node's box is at least 1 / ``parts`` of its size.

    A plane's coordinates span ``width``.  Boxes of the triangle's bounding box that lie wholly beyond one of its edges are left out.
    """
    x, y = ([F.col(k) for k in CORNERS if k.endswith(axis)] for axis in "xy")
    size = F.greatest(F.greatest(*x) - F.least(*x), F.greatest(*y) - F.least(*y))
    level = F.floor(F.log2(F.lit(width * parts) / F.greatest(size, F.lit(width * 2.0**-40))))
    t = triangles.withColumn("level", F.greatest(F.lit(0), F.least(F.lit(DEEPEST), level)).cast("int"))
    side = _side(F.col("level"), width)
    t = t.withColumn("i", F.explode(F.sequence(F.floor(F.least(*x) / side), F.floor(F.greatest(*x) / side))))
    t = t.withColumn("j", F.explode(F.sequence(F.floor(F.least(*y) / side), F.floor(F.greatest(*y) / side))))
    x0, y0 = F.col("i") * side, F.col("j") * side

    def reaches(a: str, b: str) -> Column:
        """Whether the box's corner farthest to the left of an edge is not right of it."""
        dx, dy = F.col(f"{b}x") - F.col(f"{a}x"), F.col(f"{b}y") - F.col(f"{a}y")
        far = dx * (F.when(dx > 0, y0 + side).otherwise(y0) - F.col(f"{a}y")) - dy * (F.when(dy > 0, x0).otherwise(x0 + side) - F.col(f"{a}x"))
        return far >= -1e-9 * side * (F.abs(dx) + F.abs(dy))

    return t.filter(reaches("a", "b") & reaches("b", "c") & reaches("c", "a"))


def in_triangles(triangles: DataFrame, points: DataFrame, width: float, parts: int = 2, levels: list[int] | None = None) -> DataFrame:
    """Triangles (chart, the corners, more) with the points (chart, px, py, more) that lie in them, borders included.

    The levels that hold triangles are looked up (they are 31 at most) where they are not given.
    """
    held = nodes_of_triangles(triangles, width, parts)
    if levels is None:
        levels = sorted(r[0] for r in held.select("level").distinct().collect())
    at = points.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    side = _side(F.col("level"), width)
    at = at.withColumns({"i": F.floor(F.col("px") / side), "j": F.floor(F.col("py") / side)})

    def left(a: str, b: str) -> Column:
        return (F.col(f"{b}x") - F.col(f"{a}x")) * (F.col("py") - F.col(f"{a}y")) - (F.col(f"{b}y") - F.col(f"{a}y")) * (F.col("px") - F.col(f"{a}x")) >= 0

    met = held.join(at, ["chart", "level", "i", "j"])
    return met.filter(left("a", "b") & left("b", "c") & left("c", "a")).drop("chart", "level", "i", "j", *CORNERS)


#: The numbers that an outline needs.
NEEDS = {"circle": ("ra_centre", "dec_centre", "radius_deg"), "box": ("ra_from", "ra_to", "dec_from", "dec_to"), "polygon": ("vertices",)}
_NUMBERS = (*NEEDS["circle"], *NEEDS["box"])


def region_triangles(r: dict) -> np.ndarray:
    """Triangles (n, 3, 2) of a region's polygon, and their images turned by 360 degrees where those can meet [0, 360)."""
    if r["outline"] == "circle":
        ring = circle_outline(r["ra_centre"], r["dec_centre"], r["radius_deg"])
    elif r["outline"] == "box":
        ring = box_outline(r["ra_from"], r["ra_to"], r["dec_from"], r["dec_to"])
    else:
        ring = np.array([list(v) for v in r["vertices"]], float)
    t = clip_ears(ring)
    moved = np.concatenate([t + np.array([turn, 0.0]) for turn in (-720.0, -360.0, 0.0, 360.0, 720.0)])
    return moved[(moved[:, :, 0].max(1) >= 0) & (moved[:, :, 0].min(1) < 360)]


def _clip_regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Kernel: the triangles of each region, with what the exact test of its outline needs."""
    for batch in batches:
        for r in batch.to_dict("records"):
            t = region_triangles(r)
            rows = pd.DataFrame(t.reshape(len(t), 6), columns=list(CORNERS))
            yield rows.assign(region_id=r["region_id"], outline=r["outline"], **{n: r[n] for n in _NUMBERS})


def within_outline(ra: Column, dec: Column) -> Column:
    """The exact test of a circle or box by its columns; its border belongs to it.  A polygon is its triangles."""
    a, d, a0, d0 = F.radians(ra), F.radians(dec), F.radians("ra_centre"), F.radians("dec_centre")
    h = F.pow(F.sin((d - d0) / 2), 2) + F.cos(d) * F.cos(d0) * F.pow(F.sin((a - a0) / 2), 2)
    circle = F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), h)))) <= F.col("radius_deg") + BORDER
    turn = F.lit(360.0)
    width = F.pmod(F.col("ra_to") - F.col("ra_from"), turn)
    width = F.when((width == 0) & (F.col("ra_to") != F.col("ra_from")), turn).otherwise(width)
    east = F.pmod(ra - F.col("ra_from"), turn)
    box = ((east <= width + BORDER) | (east >= 360 - BORDER)) & dec.between(F.col("dec_from") - BORDER, F.col("dec_to") + BORDER)
    return F.when(F.col("outline") == "circle", circle).when(F.col("outline") == "box", box).otherwise(True)


def regions_containing(points: DataFrame, regions: DataFrame, point_id: str = "obj_id", ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Rows (region_id, point_id), one for each region that contains a point.

    ``regions``: region_id, outline ('circle', 'box' or, with a column ``vertices``, 'polygon') and its numbers as in
    the table sky_region; there may be any number of them.  Points without an id or a position and regions without an id
    or a needed number are in no row; repeated points and regions count once; any right ascension is taken modulo
    360; empty tables give an empty result.  Other columns are not read.
    """
    there = set(regions.columns)
    given = [F.col(n).cast("double").alias(n) if n in there else F.lit(None).cast("double").alias(n) for n in _NUMBERS]
    shape = F.col("vertices").cast("array<array<double>>") if "vertices" in there else F.lit(None).cast("array<array<double>>")
    listed = regions.select(F.col("region_id").cast("long").alias("region_id"), "outline", *given, shape.alias("vertices"))
    known = F.lit(False)
    for outline, needs in NEEDS.items():
        ok = F.col("vertices").isNotNull() if outline == "polygon" else F.lit(True)
        for n in needs if outline != "polygon" else ():
            ok = ok & finite(F.col(n))
        known = known | ((F.col("outline") == outline) & ok)
    listed = listed.filter(F.col("region_id").isNotNull() & known).distinct()
    numbers = ", ".join(f"{n} double" for n in (*CORNERS, *_NUMBERS))
    triangles = listed.mapInPandas(_clip_regions, f"region_id long, outline string, {numbers}").withColumn("chart", F.lit(0))
    x, y = F.col(ra).cast("double"), F.col(dec).cast("double")
    turned = F.pmod(x, F.lit(360.0))
    at = points.filter(F.col(point_id).isNotNull() & finite(x) & finite(y)).select(
        F.col(point_id).alias("point_id"), x.alias("pra"), F.when(turned >= 360, 0.0).otherwise(turned).alias("px"), y.alias("py"), F.lit(0).alias("chart")
    )
    return in_triangles(triangles, at, 360.0).filter(within_outline(F.col("pra"), F.col("py"))).select("region_id", "point_id").distinct()


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def on_faces(half: float) -> Column:
    """Array of (chart, px, py, own): a unit vector (x, y, z) on each face of the cube on which it lies, or within ``half`` beyond its edge."""
    v = [F.col(n) for n in "xyz"]
    most = F.greatest(*map(F.abs, v))
    out = []
    for axis in range(3):
        p, q = (v[k] for k in range(3) if k != axis)
        for sign in (1, -1):
            ahead = sign * v[axis]
            u, w = p / ahead, q / ahead
            near = (ahead > 0.5) & (F.abs(u) <= 1 + half) & (F.abs(w) <= 1 + half)
            # On an edge the first axis has the point.
            own = reduce(lambda a, b: a & b, (F.abs(k) < most for k in v[:axis]), ahead == most)
            out.append(F.when(near, F.struct(F.lit(2 * axis + (sign < 0)).alias("chart"), u.alias("px"), w.alias("py"), own.alias("own"))))
    return F.array_compact(F.array(*out))


def pairs_within(points: DataFrame, arcsec: float, point_id: str = "obj_id", ra: str = "ra", dec: str = "dec") -> DataFrame:
    """Rows (id_a, id_b, sep_arcsec) of every two points at most ``arcsec`` apart, id_a < id_b.

    Each point's neighbourhood is a square of two triangles (the two ears of a convex polygon of four corners), all of one
    size and so on one level of the hierarchy.  A crowded node's rows are split over tasks by the skew handling of the
    sort-merge join; what it gives is part of the result, never a list within one row.  Points without id or position
    have no neighbours; of repeated rows of an id each position counts once.
    """
    chord = 2 * np.sin(np.radians(arcsec / 3600) / 2) * (1 + 1e-9) + 1e-15
    half = 3.05 * np.tan(min(np.radians(arcsec / 3600), 0.2)) + 1e-12  # a face stretches small angles threefold at most
    if arcsec > 3600:
        raise ValueError("a neighbourhood of one degree at most")
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    at = (
        points.select(F.col(point_id).alias("id"), F.col(ra).cast("double").alias("ra"), F.col(dec).cast("double").alias("dec"))
        .filter(F.col("id").isNotNull() & finite(F.col("ra")) & finite(F.col("dec")))
        .distinct()
        .select("id", x.alias("x"), y.alias("y"), z.alias("z"))
    )
    placed = at.withColumn("f", F.explode(on_faces(half))).select("id", "x", "y", "z", "f.*")
    own = placed.filter("own").select("chart", "px", "py", *(F.col(n).alias(f"b_{n}") for n in ("id", "x", "y", "z")))
    corner = [(F.col("px") + i * half, F.col("py") + j * half) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    ears = [F.struct(*(c.alias(n) for n, c in zip(CORNERS, (*corner[0], *corner[k], *corner[k + 1])))) for k in (1, 2)]
    squares = placed.select("chart", *(F.col(n).alias(f"a_{n}") for n in ("id", "x", "y", "z")), F.explode(F.array(*ears)).alias("t")).select("*", "t.*").drop("t")
    level = min(DEEPEST, int(np.floor(np.log2(4.0 / (2 * half)))))
    chord2 = sum(((F.col(f"a_{n}") - F.col(f"b_{n}")) ** 2 for n in "xyz"), F.lit(0.0))
    sep = F.degrees(2 * F.asin(F.least(F.sqrt(chord2) / 2, F.lit(1.0)))) * 3600
    return (
        in_triangles(squares, own, 4.0, 1, [level])
        .filter((F.col("a_id") < F.col("b_id")) & (chord2 <= chord * chord))
        .select(F.col("a_id").alias("id_a"), F.col("b_id").alias("id_b"), sep.alias("sep_arcsec"))
        .filter(F.col("sep_arcsec") <= arcsec * (1 + 1e-9))
        .groupBy("id_a", "id_b")
        .agg(F.min("sep_arcsec").alias("sep_arcsec"))
    )


def around_objects(objects: DataFrame, regions: DataFrame, arcsec: float = 5.0) -> DataFrame:
    """Rows (relation, key_a, key_b): 'near' pairs of objects and the regions objects are 'inside'."""
    near = pairs_within(objects, arcsec).select(F.lit("near").alias("relation"), F.col("id_a").alias("key_a"), F.col("id_b").alias("key_b"))
    inside = regions_containing(objects, regions)
    inside = inside.select(F.lit("inside").alias("relation"), F.col("region_id").alias("key_a"), F.col("point_id").alias("key_b"))
    return near.unionByName(inside)
