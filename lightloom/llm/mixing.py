"""Mixing sources to target shares of a corpus's tokens.

Method: balanced sampling by the cube method.  Every document of a source is expected the same number of
uses (but for documents that are larger than all that is to be drawn); whole uses are given outright, the fractional rest is its inclusion probability.  The flight phase moves
the probabilities along the null space of the balancing constraints (documents, tokens) until one more of them becomes 0
or 1: first for the largest documents, each against all others at once, then for three documents at a time.  It runs in
chunks of each source at once; the at most two undecided documents of each chunk meet in the next, smaller flight.  The last one
stops when ``LEAVE`` documents of a source are open.  These are the landing problem: the constraint on documents is
given up and they fly on by tokens alone, the largest first, until one, as a rule the smallest, is drawn by its probability.

Scale: chunks are bounded whatever a source's share of all rows; undecided documents shrink by a factor of
``CHUNK`` / 2 per level; only totals per source of a mix reach the driver.  Every choice comes from hashes of
document ids, so a task that runs again decides the same.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lightloom.llm.bpe import encode_corpus
from lightloom.session import cut

#: Documents of one source that fly together, about.
CHUNK = 20_000
#: Largest documents of a chunk that are decided against all others, so that what is left for the landing is small.
HEAVY = 512
#: Documents of a source that the last flight leaves to the landing.
LEAVE = 64
#: Rows that a table of targets may have: it is planned on the driver.
TARGETS = 100_000
_TINY = 1e-9


def _open(p: np.ndarray) -> np.ndarray:
    return np.flatnonzero((p > _TINY) & (p < 1 - _TINY))


def _move(p: np.ndarray, a: int, rest: np.ndarray, u: np.ndarray, rng: np.random.Generator) -> None:
    """One step of ``a`` by 1 and the rest by ``u``, up or down as far as a probability reaches 0 or 1, each with the chance that keeps all expectations."""
    with np.errstate(divide="ignore"):
        up = min(1 - p[a], np.where(u > 0, (1 - p[rest]) / u, np.where(u < 0, -p[rest] / u, np.inf)).min())
        down = min(p[a], np.where(u > 0, p[rest] / u, np.where(u < 0, (p[rest] - 1) / u, np.inf)).min())
    go = up if rng.random() * (up + down) < down else -down
    p[a] += go
    p[rest] += go * u
    for i in (a, *rest[(p[rest] < _TINY) | (p[rest] > 1 - _TINY)].tolist()):
        if not _TINY < p[i] < 1 - _TINY:
            p[i] = round(p[i])


def heavy_flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, heavy: int, leave: int) -> None:
    """Decides the ``heavy`` largest documents, in place: each moves along the null-space vector nearest to itself alone.

    What one large document gains or loses is spread over all others, in proportion to the room that each has.
    """
    for a in np.argsort(-x, kind="stable")[:heavy].tolist():
        while _TINY < p[a] < 1 - _TINY:
            rest = _open(p)
            rest = rest[rest != a]
            if len(rest) < max(3, leave):
                return
            room, size = np.minimum(p[rest], 1 - p[rest]), x[rest]
            s0, s1, s2 = room.sum(), (room * size).sum(), (room * size * size).sum()
            spread = s0 * s2 - s1 * s1
            if spread <= 1e-12 * s0 * s2:  # all others of one size: only a document of that size can be exchanged with them
                if abs(x[a] - s1 / s0) > 1e-9 * max(x[a], 1e-12):
                    break
                u = -room / s0
            else:
                k0, k1 = (s2 - s1 * x[a]) / spread, (s0 * x[a] - s1) / spread
                u = -room * (k0 + k1 * size)
            _move(p, a, rest, u, rng)


def flight(prob: np.ndarray, size: np.ndarray, seed: int, heavy: int = HEAVY, leave: int = 2) -> np.ndarray:
    """Probabilities after the flight: all but at most ``leave`` are 0 or 1, sums and token sums kept, and each one's expectation too."""
    rng = np.random.default_rng(seed)
    start = prob.astype(float).copy()
    scaled = size / max(float(size.mean()), 1e-12) if len(size) else size
    heavy_flight(start, scaled, rng, heavy, leave)
    many = len(_open(start))
    p, x = start.tolist(), scaled.tolist()
    draw = rng.random(len(p) + 3).tolist()
    held: list[int] = []
    step = 0
    for new in range(len(p)):
        if not _TINY < p[new] < 1 - _TINY:
            p[new] = round(p[new])
            continue
        held.append(new)
        while len(held) == 3 and many > leave:
            a, b, c = held
            # The null space of the rows (1, 1, 1) and (x_a, x_b, x_c).
            u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
            if max(map(abs, u)) < 1e-12:
                u = (1.0, -1.0, 0.0)
            up = down = math.inf
            for i, v in zip(held, u):
                if v > 1e-15:
                    up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
                elif v < -1e-15:
                    up, down = min(up, -p[i] / v), min(down, (p[i] - 1) / v)
            go = up if draw[step % len(draw)] * (up + down) < down else -down
            step += 1
            rest = []
            for i, v in zip(held, u):
                q = p[i] + go * v
                if q < _TINY or q > 1 - _TINY:
                    p[i], many = 0.0 if q < 0.5 else 1.0, many - 1
                else:
                    p[i] = q
                    rest.append(i)
            held = rest
        if many <= leave:
            break
    return np.where(np.abs(np.array(p) - 0.5) > 0.5 - _TINY, np.round(p), p) if p else np.zeros(0)


def landing(prob: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Decides the few documents that the flight left: by tokens alone, the largest first, each against all that are still open.

    Every document keeps its inclusion probability.  The last one is drawn by itself, so the tokens are off by part of its size.
    """
    q, rng = prob.astype(float).copy(), np.random.default_rng(seed + 1)
    x = size / max(float(size.mean()), 1e-12) if len(size) else size
    for a in sorted(_open(q).tolist(), key=lambda i: -x[i]):
        while _TINY < q[a] < 1 - _TINY:
            rest = _open(q)
            rest = rest[rest != a]
            room = np.minimum(q[rest], 1 - q[rest]) * x[rest]
            total = float((room * x[rest]).sum())
            if total <= 1e-12:
                q[a] = float(rng.random() < q[a])
                break
            _move(q, a, rest, -x[a] * room / total, rng)
    return q


_UNITS = "mix_name string, source string, doc_id bigint, n_tokens int, whole int, prob double"


def _fly(last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        # The largest first, so that like documents are weighed against each other.
        g = group.sort_values(["n_tokens", "place", "doc_id"], ascending=[False, True, True], kind="stable")
        seed = int(np.bitwise_xor.reduce(g["place"].to_numpy(np.int64)) & 0x7FFFFFFF)
        size = g["n_tokens"].to_numpy(float)
        p = flight(g["prob"].to_numpy(float), size, seed, leave=LEAVE if last else 2)
        return g.assign(prob=landing(p, size, seed) if last else p)[["mix_name", "source", "doc_id", "n_tokens", "whole", "prob"]]

    return run


def plan_shares(totals: dict[str, tuple[int, int]], targets: list[dict], tokens: float | None = None) -> list[dict]:
    """What each target row can be given.

    A mix's size is the greatest at which no source must exceed its repeats (or ``tokens``, if less); sources
    without tokens are unreachable, and the others then hold their shares relative to each other.
    """
    out = []
    for mix in sorted({t["mix_name"] for t in targets}):
        rows = [t for t in targets if t["mix_name"] == mix]
        live = [t for t in rows if totals.get(t["source"], (0, 0))[1] > 0 and (t["target_share"] or 0) > 0 and (t["max_repeats"] or 0) > 0]
        share = sum(t["target_share"] for t in live)
        size = min((t["max_repeats"] * totals[t["source"]][1] * share / t["target_share"] for t in live), default=0.0)
        size = min(size, tokens) if tokens is not None else size
        for t in rows:
            docs, available = totals.get(t["source"], (0, 0))
            uses = size * t["target_share"] / share / available if t in live else 0.0
            out.append(t | {"docs": docs, "available": available, "uses": min(uses, float(t["max_repeats"] or 0)), "reachable": t in live})
    return out


def _targets(mix_target: DataFrame) -> list[dict]:
    rows = mix_target.select("mix_name", "source", "target_share", "max_repeats").filter("mix_name is not null and source is not null").limit(TARGETS + 1).collect()
    if len(rows) > TARGETS:
        raise ValueError(f"more than {TARGETS} targets")
    return [r.asDict() for r in {(r["mix_name"], r["source"]): r for r in sorted(rows, key=str)}.values()]


def _draw(documents: DataFrame, mix_target: DataFrame, tokenizer: str, folder: str | None, tokens: float | None) -> tuple[DataFrame, list[dict]]:
    spark = documents.sparkSession
    targets = _targets(mix_target)
    # As many sources as targets at most, whose number is checked.
    wanted = spark.createDataFrame(sorted((t["source"],) for t in targets), "source string").distinct()
    kept = documents.filter("doc_id is not null and text is not null").join(F.broadcast(wanted), "source", "left_semi")
    # Counting rides on the id column: the source comes along as a part of it.
    keyed = kept.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), "source").alias("key"), "text")
    counted = encode_corpus(keyed, "key", "text", tokenizer, folder, lists=False).select("key.doc_id", "key.source", "n_tokens")
    counted = cut(counted.groupBy("doc_id").agg(F.min("source").alias("source"), F.max("n_tokens").alias("n_tokens")).filter("n_tokens > 0"))
    sums = counted.groupBy("source").agg(F.count("*").alias("d"), F.sum("n_tokens").alias("t")).collect()  # a row per source of a mix
    planned = plan_shares({r["source"]: (r["d"], r["t"]) for r in sums}, targets, tokens)
    live = [(t["mix_name"], t["source"], int(t["uses"] + _TINY), max(0.0, t["uses"] - int(t["uses"] + _TINY)), t["available"]) for t in planned if t["uses"] > 0]
    shares = spark.createDataFrame([(*x[:4], x[3] * x[4]) for x in live], "mix_name string, source string, whole int, prob double, goal double")
    units = counted.join(F.broadcast(shares), "source")
    # A document of more tokens than all that a source's fractional part stands for has no place in it: the others share it.
    small = F.col("n_tokens") <= F.col("goal")
    room = units.groupBy("mix_name", "source").agg(F.sum(F.when(small, F.col("n_tokens"))).alias("room"))  # a row per target
    enough = F.coalesce(F.col("room") >= F.col("goal"), F.lit(False))
    prob = F.when(~enough, F.col("prob")).when(small, F.col("goal") / F.col("room")).otherwise(0.0)
    units = units.join(F.broadcast(room), ["mix_name", "source"]).select("mix_name", "source", "doc_id", "n_tokens", "whole", prob.alias("prob"))
    most = max((t["docs"] for t in planned), default=0)
    settled, level = [units.filter(f"prob <= {_TINY}").withColumn("prob", F.lit(0.0))], 0
    units = units.filter(f"prob > {_TINY}")
    while True:
        chunks = math.ceil(most / CHUNK)
        place = F.xxhash64("doc_id", F.lit(level))
        grouped = units.withColumn("place", place).withColumn("chunk", F.pmod(F.shiftright("place", 7), F.lit(max(1, chunks))))
        flown = grouped.groupBy("mix_name", "source", "chunk").applyInPandas(_fly(chunks <= 1), _UNITS)
        if chunks <= 1:
            settled.append(flown)
            break
        flown = cut(flown)
        undecided = (F.col("prob") > _TINY) & (F.col("prob") < 1 - _TINY)
        settled.append(flown.filter(~undecided))
        units, most, level = flown.filter(undecided), 2 * chunks, level + 1
    drawn = settled[0]
    for s in settled[1:]:
        drawn = drawn.unionByName(s)
    uses = (F.col("whole") + F.col("prob").cast("int")).cast("int")
    return drawn.select("mix_name", "source", "doc_id", "n_tokens", uses.alias("uses")).filter("uses > 0"), planned


def mix(
    documents: DataFrame, mix_target: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str | None = None, tokens: float | None = None
) -> DataFrame:
    """(mix_name, source, doc_id, n_tokens, uses): the documents drawn for each mix and how often.

    Defined results: documents with a null id, source or text, or without a token, are never drawn; a repeated document
    counts once (its least source, its most tokens); sources outside a mix are not in it; a mix whose sources
    have no tokens is empty; of repeated targets one counts.
    """
    return _draw(documents, mix_target, tokenizer, folder, tokens)[0]


def mix_report(
    documents: DataFrame, mix_target: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str | None = None, tokens: float | None = None
) -> DataFrame:
    """One row per target: the share asked for and reached, of all tokens of the mix; also for sources without documents."""
    drawn, planned = _draw(documents, mix_target, tokenizer, folder, tokens)
    rows = [(t["mix_name"], t["source"], float(t["target_share"] or 0), int(t["max_repeats"] or 0), int(t["docs"]), int(t["available"]), bool(t["reachable"])) for t in planned]
    asked = documents.sparkSession.createDataFrame(
        rows, "mix_name string, source string, target_share double, max_repeats int, n_docs bigint, n_tokens bigint, reachable boolean"
    )
    used = drawn.groupBy("mix_name", "source").agg(
        F.count("*").alias("docs_used"), F.sum("uses").alias("uses"), F.max("uses").alias("most_uses"),
        F.sum(F.col("uses") * F.col("n_tokens")).alias("tokens_used"),
    )
    total = used.groupBy("mix_name").agg(F.sum("tokens_used").alias("mix_tokens"))
    none = F.lit(0)
    return (
        asked.join(F.broadcast(used), ["mix_name", "source"], "left")
        .join(F.broadcast(total), "mix_name", "left")
        .select(
            "mix_name", "source", "target_share", "max_repeats", "n_docs", "n_tokens", "reachable",
            *(F.coalesce(c, none).cast("bigint").alias(c) for c in ("docs_used", "uses", "most_uses", "tokens_used")),
            F.coalesce(F.try_divide(F.col("tokens_used"), F.col("mix_tokens")).cast("double"), F.lit(0.0)).alias("actual_share"),
        )
    )
