"""Records of two tables that describe the same things but share no key.

Method: candidate pairs share a key: a written-out name, a stretch of a badly copied number, or a cell of the sky.
Each pair gets a vector of partial, noisy similarities.  A mixture of two regularised Gaussian classes
(matched, unmatched) is fitted to these vectors without labels by expectation-maximisation; transitivity is enforced within
every expectation step, on both sides:

* two things of one table are never the same, so the candidates of a row compete with each other and with 'none';
* two rows that are one thing must be each other: what a row's posterior for a thing may be is bounded by its
  likeness to the row that claims the thing most surely, g(a, x) * g(b, x) <= g(a, b).

The result carries the posterior as confidence.

Similarities that cannot be computed are missing and count for neither class.  A differing number proves nothing
(it may come from another numbering), so low agreement of numbers is missing too.

All things that share a key with a row are its candidates, however many they are.  In the fit, though not among the candidates
of a row, the pairs of a key that many things share count together as one: such a key is no evidence of what pairs are like.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lightloom.operators.regions import finite, unit_vector
from lightloom.session import cut

FEATURES = ("f_name", "f_ref", "f_sep", "f_mag")


@dataclass
class Gaussians:
    """Means and variances by class and feature, and the matched share; the starting values are the prior."""

    share: float = 0.3
    mean: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {"f_name": (1.0, 0.1), "f_ref": (0.97, 0.7), "f_sep": (0.8, 6.0), "f_mag": (0.2, 0.0)}
    )
    var: dict[str, tuple[float, float]] = field(
        default_factory=lambda: {"f_name": (0.02, 0.05), "f_ref": (0.003, 0.01), "f_sep": (0.5, 6.0), "f_mag": (0.1, 3.0)}
    )


@dataclass(frozen=True)
class Matching:
    """Parameters of the matching; the defaults are the production values."""

    radius: float = 8.0  #: arcseconds within which a place makes a candidate
    far: float = 10.0  #: separations beyond count as this
    shared: int = 50  #: things of one name or number stretch up to which each pair counts fully in the fit; beyond, they count as one
    packed: int = 1000  #: the same for things in one cell of the sky
    stretch: int = 9  #: digits of a number at either end that make a candidate
    block: int = 1000  #: things of one key that a task meets at once
    claim: float = 0.05  #: posterior from which a row counts as claiming a thing
    agree: float = 0.8  #: agreement of numbers below this is missing
    weight: float = 25.0  #: rows that the prior of each Gaussian counts as
    floor: dict[str, float] = field(default_factory=lambda: {"f_name": 0.01, "f_ref": 0.002, "f_sep": 0.1, "f_mag": 0.01})
    rounds: int = 15
    still: float = 1e-3  #: change of the matched share that ends the rounds
    least: float = 0.5  #: posterior of a match


def name_key(name: Column) -> Column:
    """A name without case, marks, leading zeros and order: letters with a lone V first, then the numbers."""
    flat = F.regexp_replace(F.upper(name), r"(?<![A-Z])([A-Z])\.(?=[A-Z]\b)", "$1")
    flat = F.regexp_replace(flat, r"\([^)]*\)", " ")
    words = F.filter(F.regexp_extract_all(flat, F.lit(r"[A-Z]+"), 0), lambda w: ~w.isin("NO", "J"))
    words = F.concat(F.filter(words, lambda w: w == "V"), F.filter(words, lambda w: w != "V"))
    numbers = F.transform(F.regexp_extract_all(flat, F.lit(r"[0-9]+"), 0), lambda d: F.regexp_replace(d, r"^0+(?=[0-9])", ""))
    key = F.concat(F.array_join(words, ""), F.lit("|"), F.array_join(numbers, "."))
    return F.when((F.size(words) > 0) & (F.size(numbers) > 0), key)


def name_scheme(key: Column) -> Column:
    """The naming scheme of a key: 'V' for all variable-star numbers, else its letters."""
    letters = F.substring_index(key, "|", 1)
    return F.when(letters.rlike("^V[A-Z]{3}$"), "V").otherwise(letters)


def degrees_from_text(text: Column, hours: bool) -> Column:
    """Decimal or sexagesimal text in any of the usual notations as degrees; null if it is neither."""
    part = F.transform(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:\.[0-9]*)?"), 0), lambda x: x.try_cast("double"))
    sexagesimal = F.get(part, F.lit(0)) + F.get(part, F.lit(1)) / 60 + F.get(part, F.lit(2)) / 3600
    value = F.when(F.size(part) == 1, F.get(part, F.lit(0))).when(F.size(part) == 3, sexagesimal * (15 if hours else 1))
    return F.when(F.ltrim(text).startswith("-"), -value).otherwise(value)


def _bare_number(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"^\s*[A-Za-z]+ [A-Za-z]*DR[0-9]+\s*|\s", ""))


def number_digits(text: Column) -> Column:
    """The leading digits that a copied number still tells, unknown ones as 'x'; null if fewer than nine."""
    t = _bare_number(text)
    power = F.regexp_extract(t, r"^([0-9])\.([0-9]+)e\+?[0-9]+$", 1)
    digits = F.regexp_extract(t, r"^[0-9]\.([0-9]+)e\+?[0-9]+$", 1)
    # The last digit of a power of ten is rounded and tells nothing.
    shown = F.when(power != "", F.concat(power, F.substring(digits, F.lit(1), F.length(digits) - 1))).otherwise(F.regexp_extract(t, r"^[0-9x]+", 0))
    return F.when(F.length(shown) >= 9, shown)


def number_is_whole(text: Column) -> Column:
    """Whether a number is there to its last digit: nothing but digits and unknown ones."""
    return F.coalesce(_bare_number(text).rlike(r"^[0-9x]+$"), F.lit(False))


def _sides(rows: DataFrame, things: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with the columns that are compared, under names of our own; one row per id, of several the least."""
    c = F.col
    names = F.array_compact(F.concat(F.array(c("designation")), F.split(F.coalesce(c("alias"), F.lit("")), "=")))
    a = rows.filter("cat_id is not null").select(
        c("cat_id"), F.array_sort(F.array_distinct(F.array_compact(F.transform(names, name_key)))).alias("a_names"),
        number_digits(c("source_ref")).alias("a_ref"), number_is_whole(c("source_ref")).alias("a_whole"), degrees_from_text(c("ra_text"), True).alias("a_ra"),
        degrees_from_text(c("dec_text"), False).alias("a_dec"), F.when(finite(c("gmag")), c("gmag").cast("double")).alias("a_mag"),
    )
    magnitude = c("mean_mag").cast("double")
    b = things.filter("obj_id is not null").select(
        c("obj_id"), name_key(c("known_name")).alias("b_name"), number_digits(c("gaia_id")).alias("b_ref"), number_is_whole(c("gaia_id")).alias("b_whole"),
        c("ra").cast("double").alias("b_ra"), c("dec").cast("double").alias("b_dec"),
        F.when(finite(c("mean_mag")) & (magnitude < 40) & (magnitude > -5), magnitude).alias("b_mag"),
    )
    single = lambda df, key: df.groupBy(key).agg(F.min(F.struct(*[x for x in df.columns if x != key])).alias("v")).select(key, "v.*")
    return single(a, "cat_id"), single(b, "obj_id")


#: Ways to a candidate; the key is a hash of the way and what is shared.
NAME, HEAD, TAIL, PLACE = range(4)


def _keys(side: str, m: Matching) -> Column:
    """Array of (way, key, x, y, z): everything by which a record of side 'a' or 'b' may meet one of the other side."""
    ref, k = F.col(f"{side}_ref"), m.stretch
    nowhere = [F.lit(None).cast("double").alias(n) for n in "xyz"]
    key = lambda way, *what: F.struct(F.lit(way).alias("way"), F.xxhash64(F.lit(way), *what).alias("key"), *nowhere)
    names = F.transform("a_names", lambda n: key(NAME, n)) if side == "a" else F.array_compact(F.array(F.when(F.col("b_name").isNotNull(), key(NAME, F.col("b_name")))))
    # A number's end says something only if it is whole; a shortened copy has another length and meets no end.
    numbers = [F.when(ref.isNotNull(), key(HEAD, F.substring(ref, 1, k))), F.when(ref.isNotNull() & F.col(f"{side}_whole"), key(TAIL, F.length(ref), F.substring(ref, -k, k)))]
    r = 2 * math.sin(math.radians(m.radius / 3600) / 2)
    box = 4 * r
    v = unit_vector(F.col(f"{side}_ra"), F.col(f"{side}_dec"))
    reach = r if side == "a" else 0.0
    cells = [F.sequence(F.floor((u - reach) / box), F.floor((u + reach) / box)) for u in v]
    at = [u.alias(n) for u, n in zip(v, "xyz")]
    place = lambda i, j, n: F.struct(F.lit(PLACE).alias("way"), F.xxhash64(F.lit(PLACE), i, j, n).alias("key"), *at)
    places = F.flatten(F.transform(cells[0], lambda i: F.flatten(F.transform(cells[1], lambda j: F.transform(cells[2], lambda n: place(i, j, n))))))
    placed = F.when(finite(F.col(f"{side}_ra")) & finite(F.col(f"{side}_dec")), places)
    every = [names, F.array_compact(F.array(*numbers)), placed]
    none = F.array().cast("array<struct<way:int,key:bigint,x:double,y:double,z:double>>")
    return F.concat(*(F.coalesce(x, none) for x in every))


def candidates(rows: DataFrame, things: DataFrame, m: Matching = Matching()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct candidate pairs (cat_id, obj_id, weight), and both tables as they are compared.

    All things of a key are candidates of all its rows.  Where more than ``m.shared`` things share it (``m.packed`` for a
    cell of the sky) they meet the rows in blocks of about ``m.block``, so that no task has a key to itself, and each
    pair has one part of as many as there are things for its ``weight``; of a pair that meets by several keys the largest counts.
    """
    a, b = (cut(side) for side in _sides(rows, things))
    keyed_a = a.select("cat_id", F.explode(_keys("a", m)).alias("k")).select("cat_id", "k.*")
    keyed_b = b.select("obj_id", F.explode(_keys("b", m)).alias("k")).select("obj_id", "k.*")
    most = F.when(F.col("way") == PLACE, m.packed).otherwise(m.shared)
    many = cut(keyed_b.groupBy("way", "key").agg(F.count("*").alias("n")).filter(F.col("n") > most))  # crowded keys; few, as a rule
    blocks = F.ceil(F.col("n") / m.block).cast("int")
    chord2 = sum(((F.col(f"a.{n}") - F.col(f"b.{n}")) ** 2 for n in "xyz"), F.lit(0.0))
    reach = (2 * math.sin(math.radians(m.radius / 3600) / 2)) ** 2 * (1 + 1e-9)
    near = F.col("a.x").isNull() | (chord2 <= reach)

    def met(one: DataFrame, other: DataFrame, on: list[str], weight: Column) -> DataFrame:
        return one.alias("a").join(other.alias("b"), on).filter(near).select("cat_id", "obj_id", weight.alias("weight"))

    pairs = met(keyed_a, keyed_b.join(many, ["way", "key"], "left_anti"), ["way", "key"], F.lit(1.0))
    if not many.isEmpty():
        rows_in = keyed_a.join(many, ["way", "key"]).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")
        things_in = keyed_b.join(many, ["way", "key"]).withColumn("block", F.pmod(F.xxhash64("obj_id"), blocks).cast("int"))
        pairs = pairs.unionByName(met(rows_in, things_in, ["way", "key", "block"], 1 / F.col("n")))
    return pairs.groupBy("cat_id", "obj_id").agg(F.max("weight").alias("weight")), a, b


def separation(one: str = "a", other: str = "b") -> Column:
    """Arcseconds between the two sides' places; null if either has none."""
    (ra, dec), (ra2, dec2) = ((F.col(f"{s}_ra"), F.col(f"{s}_dec")) for s in (one, other))
    chord = F.sqrt(sum(((p - q) ** 2 for p, q in zip(unit_vector(ra, dec), unit_vector(ra2, dec2))), F.lit(0.0)))
    sep = F.degrees(2 * F.asin(F.least(chord / 2, F.lit(1.0)))) * 3600
    return F.when(finite(ra) & finite(dec) & finite(ra2) & finite(dec2), sep)


def _compared(names: Column, names2: Column, ref: Column, ref2: Column, sep: Column, step: Column, m: Matching) -> list[Column]:
    """One column per feature; a feature that tells nothing is null."""
    schemes = F.transform(names2, name_scheme)
    comparable = F.exists(names, lambda n: F.array_contains(schemes, name_scheme(n)))
    name = F.when(F.arrays_overlap(names, names2), 1.0).when(comparable, 0.0)
    length = F.least(F.length(ref), F.length(ref2))
    place = F.sequence(F.lit(1), length)
    known = F.filter(place, lambda i: (F.substring(ref, i, F.lit(1)) != "x") & (F.substring(ref2, i, F.lit(1)) != "x"))
    alike = F.filter(known, lambda i: F.substring(ref, i, F.lit(1)) == F.substring(ref2, i, F.lit(1)))
    agreement = F.when(length >= m.stretch, F.try_divide(F.size(alike).cast("double"), F.size(known).cast("double")))
    return [
        name.cast("double").alias("f_name"), F.when(agreement >= m.agree, agreement).alias("f_ref"), F.when(sep > m.far, F.lit(m.far)).otherwise(sep).alias("f_sep"),
        F.when(F.abs(step) > 3, 3 * F.signum(step)).otherwise(step).alias("f_mag"),
    ]


#: What tells two rows of one thing apart: their names and numbers are those of two listings, and differ without contradiction.
ROW = ("a_ra", "a_dec", "a_mag")


def similarities(pairs: DataFrame, a: DataFrame, b: DataFrame, m: Matching = Matching()) -> DataFrame:
    """(cat_id, obj_id, weight, one column per feature, the row's own columns), the pairs of a row side by side."""
    both = pairs.join(a.drop("a_whole"), "cat_id").join(b.drop("b_whole"), "obj_id")
    name = F.array_compact(F.array("b_name"))
    features = _compared(F.col("a_names"), name, F.col("a_ref"), F.col("b_ref"), separation(), F.col("a_mag") - F.col("b_mag"), m)
    return both.select("cat_id", "obj_id", "weight", *features, *ROW).repartition("cat_id").sortWithinPartitions("cat_id", "obj_id")


def log_odds(g: Gaussians, features: dict[str, np.ndarray]) -> np.ndarray:
    """Of matched to unmatched; missing features (NaN) say nothing."""
    out = np.full(len(features[FEATURES[0]]), math.log(g.share / (1 - g.share)))
    for f in FEATURES:
        (m1, m0), (v1, v0) = g.mean[f], g.var[f]
        x = features[f]
        term = (x - m0) ** 2 / (2 * v0) - (x - m1) ** 2 / (2 * v1) + 0.5 * math.log(v0 / v1)
        out += np.where(np.isnan(x), 0.0, term)
    return np.clip(out, -300, 300)


def _sums(p: np.ndarray, weight: np.ndarray, features: dict[str, np.ndarray]) -> list[float]:
    """What the next parameters are made of: pairs, posteriors, and for each feature and class weight, weighted values and squares."""
    out = [float(weight.sum()), float((weight * p).sum())]
    for f in FEATURES:
        x = features[f]
        seen = ~np.isnan(x)
        for w in ((weight * p)[seen], (weight * (1 - p))[seen]):
            out += [float(w.sum()), float((w * x[seen]).sum()), float((w * x[seen] ** 2).sum())]
    return out


def _competition(g: Gaussians, m: Matching):
    """Kernel over pairs sorted by row: claims (posterior from ``m.claim`` on) as they are, all other pairs as one row of sums a batch.

    A row's candidates and 'none of them' share a probability of one.
    """

    def scored(t: pa.Table) -> pa.RecordBatch:
        ids = t["cat_id"].to_numpy()
        start = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        features = {f: t[f].to_numpy().astype(float) for f in FEATURES}
        odds = np.exp(log_odds(g, features))
        total = np.add.reduceat(odds, start)
        p = odds / (1 + np.repeat(total, np.diff(np.append(start, len(ids)))))
        claims = p >= m.claim
        sums = _sums(p[~claims], t["weight"].to_numpy()[~claims], {f: features[f][~claims] for f in FEATURES})
        at = pa.array(np.flatnonzero(claims))
        kept = t.take(at).append_column("p", pa.array(p[claims])).append_column("sums", pa.nulls(len(at), pa.list_(pa.float64())))
        rest = pa.table({n: pa.nulls(1, kept.schema.field(n).type) if n != "sums" else pa.array([sums], pa.list_(pa.float64())) for n in kept.column_names})
        return pa.concat_tables([kept, rest]).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row's pairs may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
            ids = t["cat_id"].to_numpy()
            end = int(np.argmax(ids == ids[-1]))
            if end:
                yield scored(t.slice(0, end).combine_chunks())
            held = t.slice(end)
        if held is not None:
            yield scored(held.combine_chunks())

    return run


def expectation(pairs: DataFrame, g: Gaussians, m: Matching = Matching()) -> DataFrame:
    """Claims (cat_id, obj_id) with their posteriors ``p`` under both constraints, and rows of ``sums`` over all pairs.

    The bound of a claim compares its row with that of the thing's surest claim, so no pairs of rows are formed beyond one a claim.
    Parameters only enter the kernels, so the plan's code is the same in every round.
    """
    types = dict(pairs.dtypes)
    schema = ", ".join(f"{n} {types[n]}" for n in pairs.columns) + ", p double, sums array<double>"
    scored = pairs.mapInArrow(_competition(g, m), schema)
    # The surest claim of a thing: one row per thing, combined before the shuffle, so a thing may have any number of claims.
    first = F.max(F.struct("p", (-F.col("cat_id")).alias("who"), *ROW)).alias("b")
    best = scored.filter("obj_id is not null").groupBy("obj_id").agg(first, F.count("*").alias("n")).filter("n > 1")
    best = best.select("obj_id", F.col("b.p").alias("b_p"), (-F.col("b.who")).alias("b_id"), *(F.col(f"b.{c}").alias(f"b{c[1:]}") for c in ROW))
    joined = scored.join(best, "obj_id", "left")
    other = F.when(F.col("b_id") != F.col("cat_id"), F.col("b_p")).alias("b_p")
    columns = ["cat_id", "obj_id", "weight", *FEATURES, "p", "sums", other, *ROW, *(f"b{c[1:]}" for c in ROW)]
    return joined.select(*columns).mapInArrow(_likeness(g, m), f"cat_id {types['cat_id']}, obj_id {types['obj_id']}, p double, sums array<double>")


def arcseconds(ra: np.ndarray, dec: np.ndarray, ra2: np.ndarray, dec2: np.ndarray) -> np.ndarray:
    """Separations of places in degrees; NaN where one is missing."""
    a, d, a2, d2 = (np.radians(x) for x in (ra, dec, ra2, dec2))
    h = np.sin((d - d2) / 2) ** 2 + np.cos(d) * np.cos(d2) * np.sin((a - a2) / 2) ** 2
    return np.degrees(2 * np.arcsin(np.sqrt(np.clip(h, 0, 1)))) * 3600


def _likeness(g: Gaussians, m: Matching):
    """Kernel over claims: their bounded posteriors, and a batch's sums together with those that came along."""
    # Two rows of one thing differ by twice the variance of one from the thing, in magnitude by nothing on average; that
    # both claim the thing speaks for them.
    mean = {"f_mag": (0.0, 0.0), "f_sep": (math.sqrt(2) * g.mean["f_sep"][0], g.mean["f_sep"][1])}
    like = Gaussians(0.9, g.mean | mean, {f: (2 * v1, v0) for f, (v1, v0) in g.var.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            claims = t.filter(pc.is_valid(t["p"]))
            v = {n: claims[n].to_numpy().astype(float) for n in ("p", "b_p", "weight", *FEATURES, *ROW, *(f"b{c[1:]}" for c in ROW))}
            none = np.full(len(v["p"]), np.nan)
            sep, step = arcseconds(v["a_ra"], v["a_dec"], v["b_ra"], v["b_dec"]), v["a_mag"] - v["b_mag"]
            told = {"f_name": none, "f_ref": none, "f_sep": np.minimum(sep, m.far), "f_mag": np.clip(step, -3, 3)}
            alike = 1 / (1 + np.exp(-log_odds(like, told)))
            alone = np.isnan(v["b_p"])
            p = np.minimum(v["p"], np.where(alone, 1.0, alike / np.where(alone, 1.0, v["b_p"])))
            total = np.array(_sums(p, v["weight"], {f: v[f] for f in FEATURES}))
            for row in t.filter(pc.is_valid(t["sums"]))["sums"].to_pylist():
                total += row
            ids = [pa.concat_arrays(claims[n].chunks) if claims[n].num_chunks else pa.array([], claims[n].type) for n in ("cat_id", "obj_id")]
            names = ["cat_id", "obj_id", "p", "sums"]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(p), pa.nulls(len(p), pa.list_(pa.float64()))], names=names)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, ids[0].type), pa.nulls(1, ids[1].type), pa.nulls(1, pa.float64()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=names)

    return run


def fit(pairs: DataFrame, m: Matching = Matching()) -> Gaussians:
    """EM over all pairs; each round brings one row of sums to the driver."""
    prior, g = Gaussians(), Gaussians()
    width = 2 + 6 * len(FEATURES)
    for _ in range(m.rounds):
        t = expectation(pairs, g, m).agg(*(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width))).first()
        if not t[0]:
            return g
        share, mean, var = float(t[1] + 1) / float(t[0] + 2), {}, {}
        for i, f in enumerate(FEATURES):
            means, variances = [], []
            for k in range(2):
                w, wx, wxx = map(float, t[2 + 6 * i + 3 * k : 5 + 6 * i + 3 * k])
                w0, m0, v0 = m.weight, prior.mean[f][k], prior.var[f][k]
                mu = (wx + w0 * m0) / (w + w0)
                spread = wxx - 2 * mu * wx + w * mu * mu
                means.append(mu)
                variances.append(max((spread + w0 * (v0 + (m0 - mu) ** 2)) / (w + w0), m.floor[f]))
            mean[f], var[f] = tuple(means), tuple(variances)
        moved = abs(share - g.share)
        g = Gaussians(share, mean, var)
        if moved < m.still:
            break
    return g


def match_entities(rows: DataFrame, things: DataFrame, m: Matching = Matching()) -> DataFrame:
    """(cat_id, obj_id, confidence): for each row the thing it is, with its posterior, if that is above ``m.least``.

    ``rows``: columns as in catalog_source; ``things``: as in sky_object.  Defined results: rows or things without an
    id are left out; a row with nothing to compare matches nothing; repeated rows count once; equal
    posteriors leave none above one half; empty tables give an empty result; other columns are not read.
    """
    pairs = cut(similarities(*candidates(rows, things, m), m))
    scored = expectation(pairs, fit(pairs, m), m).filter(F.col("p") > m.least)
    return scored.groupBy("cat_id").agg(F.max_by("obj_id", F.struct("p", "obj_id")).alias("obj_id"), F.max("p").alias("confidence"))
