"""References to records that do not exist, are deleted or arrive later.

Method: references are composite keys whose parts may be null.  Rows are grouped by their null mask, and each
mask is anti-joined on its non-null columns, under the declared match semantics:

* ``each``: every part refers to its own parent table; each non-null part is a reference by itself;
* ``simple``: a key with any null part refers to nothing; else all parts together must exist;
* ``partial``: the non-null parts together must exist in some parent row;
* ``full``: a key is wholly null (refers to nothing) or wholly given; a mixed one is an orphan at once.

A parent counts from ``since`` until it is removed; a reference made before that is an orphan too.

All masks go through one anti-join: a reference asks, by its mask, for the values of its non-null columns, a parent row
answers every mask on that mask's columns, and the mask is part of the join's key.  So both sides are read once, however
many masks there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Parent:
    """A parent table: its key columns, in the order of the reference's, and its times of life."""

    rows: DataFrame
    key: tuple[str, ...]
    since: str | None = None
    removed: str | None = None

    def life(self) -> tuple[DataFrame, Column]:
        """The rows that are not removed, and the time from which each exists."""
        rows = self.rows.filter(F.col(self.removed).isNull()) if self.removed else self.rows
        return rows, F.col(self.since).cast("timestamp") if self.since else F.timestamp_micros(F.lit(-(1 << 60)))


@dataclass(frozen=True)
class Ask:
    """What a null mask makes a reference ask for: the columns that together must be in a parent."""

    mask: str
    have: tuple[int, ...]
    part: str

    @property
    def name(self) -> str:
        return f"{self.mask}>{self.part}"


def asks_of(key: tuple[str, ...], match: str) -> tuple[list[Ask], list[Ask]]:
    """By mask: what is anti-joined, and what is an orphan at once."""
    asks, at_once = [], []
    for given in product((True, False), repeat=len(key)):
        mask, have = "".join("x" if g else "-" for g in given), tuple(p for p, g in enumerate(given) if g)
        whole = Ask(mask, have, "+".join(key[p] for p in have))
        if not have or (match == "simple" and len(have) < len(key)):
            continue
        if match == "each":
            asks += [Ask(mask, (p,), key[p]) for p in have]
        elif match == "full" and len(have) < len(key):
            at_once.append(whole)
        else:
            asks.append(whole)
    return asks, at_once


def _columns(ask: Ask, values: list[Column], types: list[str]) -> list[Column]:
    """The key columns of an ask, null where it does not look."""
    return [(v if p in ask.have else F.lit(None)).cast(t).alias(f"k{p}") for p, (v, t) in enumerate(zip(values, types))]


def _answers(parents: tuple[Parent, ...], asks: list[Ask], match: str) -> DataFrame:
    """(ask, k0, k1, ..., since): a row per ask and key that a parent answers, aggregated before its shuffle."""
    kinds = [dict(q.rows.dtypes) for q in parents]
    types = [kinds[p][q.key[0]] for p, q in enumerate(parents)] if match == "each" else [kinds[0][c] for c in parents[0].key]
    out = []
    for n, parent in enumerate(parents):
        rows, since = parent.life()
        own = [a for a in asks if match != "each" or a.have == (n,)]
        values = [F.col(parent.key[0 if match == "each" else p]) for p in range(len(types))]
        known = [F.when(sum((values[p].isNull().cast("int") for p in a.have), F.lit(0)) == 0, F.struct(F.lit(a.name).alias("ask"), *_columns(a, values, types))) for a in own]
        answered = rows.select(since.alias("since"), F.explode(F.array_compact(F.array(*known))).alias("a")).select("a.*", "since")
        out.append(answered.groupBy("ask", *(f"k{p}" for p in range(len(types)))).agg(F.min("since").alias("since")))
    return reduce(DataFrame.unionByName, out)


def orphans(
    refs: DataFrame, id_column: str, key: tuple[str, ...], parents: tuple[Parent, ...], match: str = "each",
    at: str | None = None,
) -> DataFrame:
    """Distinct rows (ref_id, mask, part, at) of orphan references.

    ``mask`` has a letter of 'x' or '-' (null) for each part; ``part`` names the offending column ('each') or
    all non-null columns joined by '+'.  For 'each' give one parent (of one key column) per part, else a single
    parent.  Repeated rows count once; rows with a wholly null key refer to nothing; a reference or
    parent without a time is held to be in time; empty references give an empty result, an empty parent makes
    every reference an orphan.
    """
    if match not in ("each", "simple", "partial", "full"):
        raise ValueError(f"unknown match semantics: {match}")
    if len(parents) != (len(key) if match == "each" else 1):
        raise ValueError("one parent per part for 'each', one parent for all parts otherwise")
    moment = F.col(at).cast("timestamp") if at else F.lit(None).cast("timestamp")
    parts, kinds = range(len(key)), dict(refs.dtypes)
    keyed = refs.select(F.col(id_column).alias("ref_id"), *(F.col(c).alias(f"k{p}") for p, c in enumerate(key)), moment.alias("at"))
    keyed = keyed.withColumn("mask", F.concat(*(F.when(F.col(f"k{p}").isNull(), "-").otherwise("x") for p in parts)))
    asks, at_once = asks_of(key, match)
    types = [kinds[c] for c in key]
    values = [F.col(f"k{p}") for p in parts]
    asked = [F.when(F.col("mask") == a.mask, F.struct(F.lit(a.name).alias("ask"), F.lit(a.part).alias("part"), *_columns(a, values, types))) for a in asks]
    grouped = keyed.select("ref_id", "mask", "at", F.explode(F.array_compact(F.array(*asked))).alias("a")).select("ref_id", "mask", "at", "a.*")
    # One row per key on the parents' side, so a key that many references share multiplies nothing, and a hot key's
    # references are split by the skew handling of the sort-merge join.
    r, p = grouped.alias("r"), _answers(parents, asks, match).alias("p")
    same = reduce(lambda x, y: x & y, (F.col(f"r.k{k}").eqNullSafe(F.col(f"p.k{k}")) for k in parts), F.col("r.ask") == F.col("p.ask"))
    in_time = F.col("r.at").isNull() | F.col("p.since").isNull() | (F.col("p.since") <= F.col("r.at"))
    out = r.join(p, same & in_time, "left_anti").select("ref_id", "mask", "part", "at")
    if at_once:
        mixed = [F.when(F.col("mask") == a.mask, F.lit(a.part)) for a in at_once]
        out = out.unionByName(keyed.withColumn("part", F.coalesce(*mixed)).filter("part is not null").select("ref_id", "mask", "part", "at"))
    return out.distinct()


def review_orphans(reviews: DataFrame, objects: DataFrame, nights: DataFrame) -> DataFrame:
    """Rows (review_id, ref_field, saved_month) of saved reviews that point to no object or no night."""
    found = orphans(
        reviews, "review_id", ("obj_id", "night_id"),
        (Parent(objects, ("obj_id",), "loaded_at", "removed_at"), Parent(nights, ("night_id",), "loaded_at", "removed_at")),
        at="saved_at",
    )
    month = F.date_format("at", "yyyy-MM")
    return found.select(F.col("ref_id").alias("review_id"), F.col("part").alias("ref_field"), month.alias("saved_month")).distinct()


def orphan_report(found: DataFrame, name: str) -> DataFrame:
    """Orphans per referring table, column and month: a small aggregate, combined before its shuffle."""
    return found.groupBy("ref_field", "saved_month").agg(F.count("*").alias("n_orphans")).withColumn("ref_table", F.lit(name))
