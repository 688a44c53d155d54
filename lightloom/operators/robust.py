"""Robust statistics as aggregate plans.  'Missing' is null here; callers turn NaN into null first (``clean``)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAD = 1.4826


def median(x: Column | str) -> Column:
    return F.percentile(x, F.lit(0.5))


def exact_quantiles(df: DataFrame, by: list[str], x: str, qs: list[float], accuracy: int = 10_000) -> DataFrame:
    """(by, n, q): the exact, linearly interpolated quantiles of each key as an array, for keys that may hold any share of all rows.

    A bounded sketch, whose error in ranks is known, gives values that enclose each quantile; the rows below are counted,
    and only distinct values in between, a few ten-thousandths of the rows, are put in order with their numbers.  All but those
    combine before their shuffle, and no buffer holds a key's values.  Null and NaN are left out.
    """
    keys = by or ["__all"]
    rows = df.select(*by, F.col(x).cast("double").alias("__x")).filter(F.col("__x").isNotNull() & ~F.isnan("__x"))
    rows = rows if by else rows.withColumn("__all", F.lit(0))
    slack = 3 / accuracy
    around = [p for q in qs for p in (max(q - slack, 0.0), min(q + slack, 1.0))]
    ends = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("__x", [float(p) for p in around], accuracy).alias("__p"))
    met = rows.join(ends, keys)
    few = F.col("n") <= accuracy  # of so few rows, all: a rank may be a large part of them
    low = lambda i: F.when(few, -math.inf).otherwise(F.col("__p")[2 * i])
    high = lambda i: F.when(few, math.inf).otherwise(F.col("__p")[2 * i + 1])
    under = met.groupBy(*keys).agg(F.first("n").alias("n"), *(F.count_if(F.col("__x") < low(i)).alias(f"__b{i}") for i in range(len(qs))))
    inside = F.array_compact(F.array(*(F.when(F.col("__x").between(low(i), high(i)), F.lit(i)) for i in range(len(qs)))))
    counted = met.select(*keys, "__x", F.explode(inside).alias("__i")).groupBy(*keys, "__i", "__x").agg(F.count("*").alias("__c"))
    run = F.sum("__c").over(Window.partitionBy(*keys, "__i").orderBy("__x"))
    placed = counted.withColumn("__r", run).join(under, keys)
    below = F.element_at(F.array(*(F.col(f"__b{i}") for i in range(len(qs)))), F.col("__i") + 1)
    rank = F.element_at(F.array(*(F.lit(float(q)) for q in qs)), F.col("__i") + 1) * (F.col("n") - 1)
    at = lambda r: F.min(F.when(below + F.col("__r") > r, F.col("__x")))
    both = placed.groupBy(*keys, "__i").agg(F.first("n").alias("n"), at(F.floor(rank)).alias("__a"), at(F.ceil(rank)).alias("__z"), F.first(rank - F.floor(rank)).alias("__f"))
    value = F.col("__a") + (F.col("__z") - F.col("__a")) * F.col("__f")
    out = both.groupBy(*keys).agg(F.first("n").alias("n"), F.array(*(F.max(F.when(F.col("__i") == i, value)) for i in range(len(qs)))).alias("q"))
    return out if by else out.drop("__all")


def with_mad(df: DataFrame, by: list[str], x: str, out: str = "sigma") -> DataFrame:
    """(by, median, sigma, n): 1.4826 * the median absolute deviation; infinite where that is 0.

    The median comes from a window over the same keys as the aggregate after it, so rows are shuffled once; the rows of
    one key pass through a buffer that spills.
    """
    centred = df.withColumn("__m", median(x).over(Window.partitionBy(*by)))
    spread = centred.groupBy(*by).agg(median(F.abs(F.col(x) - F.col("__m"))).alias("mad"), F.first("__m").alias("median"), F.count(x).alias("n"))
    return spread.select(*by, "median", F.when(F.col("mad") == 0, float("inf")).otherwise(MAD * F.col("mad")).alias(out), "n")


def clipped_mean(df: DataFrame, by: list[str], x: str, sigma: str, clip: float = 3.0, rounds: int = 3) -> DataFrame:
    """(by, mean, error, n): inverse-variance mean, clipped about the median residual by its MAD in fixed rounds.

    All rounds are windows over the same keys, so rows are shuffled and sorted once.
    """
    own = Window.partitionBy(*by)
    rows = df.filter(F.col(x).isNotNull() & (F.col(sigma) > 0)).withColumn("__w", 1 / F.col(sigma) ** 2)
    for _ in range(rounds):
        mean = F.sum(F.col("__w") * F.col(x)).over(own) / F.sum("__w").over(own)
        rows = rows.withColumn("__r", F.col(x) - mean)
        rows = rows.withColumn("__r", F.abs(F.col("__r") - median("__r").over(own)))
        rows = rows.withColumn("__s", MAD * median("__r").over(own))
        rows = rows.filter((F.col("__s") == 0) | (F.col("__r") <= clip * F.col("__s"))).drop("__r", "__s")
    return rows.groupBy(*by).agg(
        (F.sum(F.col("__w") * F.col(x)) / F.sum("__w")).alias("mean"), (1 / F.sqrt(F.sum("__w"))).alias("error"), F.count("*").alias("n")
    )


def leave_one_out(df: DataFrame, by: list[str], x: str, weight: str, out: str = "others") -> DataFrame:
    """Each row's weighted mean of the other rows of its key; null where there is no other."""
    w = Window.partitionBy(*by)
    sw, swx = F.sum(weight).over(w), F.sum(F.col(weight) * F.col(x)).over(w)
    rest = sw - F.col(weight)
    others = F.count("*").over(w) > 1
    return df.withColumn(out, F.when(others & (rest > 0), (swx - F.col(weight) * F.col(x)) / rest))


def argmax(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order that should be total."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter("rank = 1").drop("rank")


def bin_of(x: Column, edges: Column) -> Column:
    """Number of the half-open bin of a value, the last one closed; null outside."""
    n = F.size(edges) - 1
    below = F.size(F.filter(edges, lambda e: e <= x))
    return F.when((x < F.get(edges, F.lit(0))) | (x > F.get(edges, n)), None).otherwise(F.least(below, n) - 1)


def interpolate(x: Column, xs: Column, ys: Column) -> Column:
    """Linear interpolation through ascending points, constant beyond both ends."""
    n = F.size(xs)
    k = F.size(F.filter(xs, lambda v: v <= x))
    x0, x1, y0, y1 = F.get(xs, k - 1), F.get(xs, k), F.get(ys, k - 1), F.get(ys, k)
    return F.when(n == 0, None).when(k == 0, F.get(ys, F.lit(0))).when(k >= n, F.get(ys, n - 1)).otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0))


def running_median(x: str, by: list[str], order: str, half: int) -> Column:
    """Median of the 2 * half + 1 rows about a row, of at least half + 1 that have a value."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-half, half)
    return F.when(F.count(x).over(w) >= half + 1, F.percentile(x, F.lit(0.5)).over(w))


def islands(df: DataFrame, by: list[str], order: str, on: Column) -> DataFrame:
    """(by, first, last, n): unbroken runs of rows for which ``on`` holds."""
    w = Window.partitionBy(*by).orderBy(order)
    rank = df.select(*by, F.col(order).alias("o"), on.alias("on"), F.row_number().over(w).alias("r")).filter("on")
    group = F.col("r") - F.row_number().over(Window.partitionBy(*by).orderBy("o"))
    return rank.withColumn("g", group).groupBy(*by, "g").agg(F.min("o").alias("first"), F.max("o").alias("last"), F.count("*").alias("n")).drop("g")


def counts_within(df: DataFrame, by: str, key: str, t: str, half: str) -> DataFrame:
    """(by, key, n): how many other rows of the same group lie within each row's own half width of its time.

    Starts, times and ends stand in one order and a running sum is read off at both ends: no pair is formed.
    """
    at = lambda x, k: df.select(by, key, x.alias("x"), F.lit(k).alias("k"))
    marks = at(F.col(t) - F.col(half), 0).unionByName(at(F.col(t), 1)).unionByName(at(F.col(t) + F.col(half), 2))
    w = Window.partitionBy(by).orderBy("x", "k").rowsBetween(Window.unboundedPreceding, 0)
    seen = marks.withColumn("seen", F.sum((F.col("k") == 1).cast("long")).over(w)).filter("k <> 1")
    return seen.groupBy(by, key).agg((F.sum(F.when(F.col("k") == 2, F.col("seen")).otherwise(-F.col("seen"))) - 1).alias("n"))
