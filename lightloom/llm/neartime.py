"""Nearest record in time of the same entity, within a tolerance.

Method: tick expansion.  Right records are exploded to every tick of ``tolerance / ticks`` within the
tolerance; each (entity, tick) keeps the nearest right record before the tick, the nearest after it and the
first and last inside it; left records then equi-join on their own tick and choose the nearest of
these four.  That is exact while a tick holds at most two right times.  The few denser ticks take an exact
way: such a tick is cut into ``PARTS`` stretches, within each the distinct left and right times are sorted together and the
neighbours read off, and what a stretch lacks on one side comes from the next stretch that has any.

Scale: the expansion is a constant number of rows per right record, an (entity, tick) is one row of constant
size whatever the entity's share of all rows, the join never multiplies left rows, and no group is collected.  Of a
crowded tick only distinct times are sorted, each stretch by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lightloom.session import cut


#: Stretches of a crowded tick.
PARTS = 256


def _usable(df: DataFrame, entity: list[str], row_id: str, time: str, names: list[str]) -> DataFrame:
    kept = [F.col(e).alias(n) for e, n in zip(entity, names)]
    t = F.col(time).cast("double")
    return df.select(*kept, F.col(row_id).alias("id"), t.alias("t")).filter(
        F.col("id").isNotNull() & F.col("t").isNotNull() & ~F.isnan("t") & (F.abs("t") < float("inf"))
    ).dropna(subset=names)


def nearest_in_time(
    left: DataFrame, right: DataFrame, entity: list[str], left_id: str, left_time: str, right_id: str, right_time: str,
    tolerance: float, ticks: int = 4, right_entity: list[str] | None = None,
) -> DataFrame:
    """Rows (left_id, right_id, gap): each left record's nearest right record, at most ``tolerance`` away.

    Defined results: records with a null id, entity or time (NaN and infinite too) pair with nothing and give
    no row; repeated records count once; of right records equally near, and of right records at
    one time, the one of the smallest id is chosen; empty tables give an empty result.  Only the named
    columns are used, so others may clash.
    """
    e = [f"e{k}" for k in range(len(entity))]
    width = max(tolerance / ticks, 1e-9)  # a tolerance of 0 pairs equal times
    tick_of: Column = F.floor(F.col("t") / width)
    lefts = _usable(left, entity, left_id, left_time, e).distinct().withColumn("tick", tick_of)
    rights = (
        _usable(right, right_entity or entity, right_id, right_time, e).groupBy(*e, "t").agg(F.min("id").alias("id"))
    )
    reach = tolerance * (1 + 1e-9) + 1e-9
    exploded = rights.withColumn("own", tick_of).withColumn(
        "tick", F.explode(F.sequence(F.floor((F.col("t") - reach) / width), F.floor((F.col("t") + reach) / width)))
    )
    t, own, tick = F.col("t"), F.col("own"), F.col("tick")
    before, after, inside = F.when(own < tick, t), F.when(own > tick, t), F.when(own == tick, t)
    best = exploded.groupBy(*e, "tick").agg(
        F.max(before).alias("t0"), F.max_by("id", before).alias("i0"),
        F.min(after).alias("t1"), F.min_by("id", after).alias("i1"),
        F.min(inside).alias("t2"), F.min_by("id", inside).alias("i2"),
        F.max(inside).alias("t3"), F.max_by("id", inside).alias("i3"), F.count(inside).alias("inside"),
    )
    joined = cut(lefts.join(best, [*e, "tick"]))  # a row per left record; read by both ways below
    near = [F.when(F.col(f"t{k}").isNotNull(), F.struct(F.abs(t - F.col(f"t{k}")).alias("gap"), F.col(f"i{k}").alias("id"))) for k in range(4)]
    sparse = joined.filter("inside <= 2").select(F.col("id").alias("left_id"), F.array_min(F.array_compact(F.array(*near))).alias("near"))

    # The exact way for ticks with more right times than the four kept.
    crowded = joined.filter("inside > 2")
    keys = crowded.select(*e, "tick", "t0", "i0", "t1", "i1").distinct()
    outside = [keys.select(*e, "tick", F.col(f"t{k}").alias("t"), F.col(f"i{k}").alias("right")).dropna(subset=["t"]) for k in (0, 1)]
    within = rights.withColumn("tick", tick_of).join(keys.select(*e, "tick"), [*e, "tick"], "left_semi").select(*e, "tick", "t", F.col("id").alias("right"))
    asked = crowded.select(*e, "tick", "t").distinct()
    line = within.unionByName(outside[0]).unionByName(outside[1]).unionByName(asked, allowMissingColumns=True)
    place, seen = [*e, "tick", "part"], F.when(F.col("right").isNotNull(), F.struct("t", "right"))
    line = line.withColumns({"part": F.floor(F.col("t") / (width / PARTS)), "seen": seen})
    rows = (Window.unboundedPreceding, Window.currentRow)
    w = Window.partitionBy(*place)
    near = (
        line.withColumn("a", F.last("seen", ignorenulls=True).over(w.orderBy("t", F.col("right").isNull()).rowsBetween(*rows)))
        .withColumn("b", F.last("seen", ignorenulls=True).over(w.orderBy(F.desc("t"), F.col("right").isNull()).rowsBetween(*rows)))
        .filter("right is null")
    )
    ends = line.groupBy(*place).agg(F.max("seen").alias("hi"), F.min("seen").alias("lo"))
    order = Window.partitionBy(*e, "tick").orderBy("part")
    before = F.last("hi", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("lo", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    near = near.join(ends.select(*place, before.alias("before"), after.alias("after")), place)
    sides = [F.when(F.col(x).isNotNull(), F.struct(F.abs(t - F.col(x)["t"]).alias("gap"), F.col(x)["right"].alias("id"))) for x in ("a", "b", "before", "after")]
    answered = near.select(*e, "tick", "t", F.array_min(F.array_compact(F.array(*sides))).alias("near"))
    crowd = crowded.select(*e, "tick", "t", F.col("id").alias("left_id")).join(answered, [*e, "tick", "t"]).select("left_id", "near")
    return (
        sparse.unionByName(crowd)
        .select("left_id", F.col("near.id").alias("right_id"), F.col("near.gap").alias("gap"))
        .filter(F.col("gap") <= tolerance)
    )


def lost_partners(shapes: DataFrame, detections: DataFrame, frames: DataFrame) -> DataFrame:
    """Rows (pairing, left_id, right_id): the transit detection of each fitted shape, the exposure of each detection."""
    first = nearest_in_time(
        shapes, detections.filter("kind = 'transit'"), ["obj_id"], "shape_id", "tc", "det_id", "tc_bjd_tdb", 0.05
    )
    second = nearest_in_time(
        detections, frames, ["night_id"], "det_id", "tc_bjd_tdb", "frame_id", "bjd_tdb", 0.01, ticks=3
    )
    return (
        first.withColumn("pairing", F.lit("shape_detection"))
        .unionByName(second.withColumn("pairing", F.lit("detection_frame")))
        .select("pairing", "left_id", "right_id")
    )
