"""Cutting oversized texts into pieces at natural boundaries.

Method: recursive bisection.  A stretch that exceeds the limit less the overlap is cut at the strongest boundary
of its middle half (of equally strong ones, the nearest to the midpoint) and both parts are treated alike; then
each piece after the first is given the last tokens of the one before.

Boundaries, strongest first: paragraph, line, sentence, clause, word, pre-token; within one pre-token longer than
the limit, a token that begins a character, then any token.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lightloom.llm.bpe import Encoder, encoder, rank_file, text_slices

_SENTENCE, _CLAUSE = ".!?…", ",;:"
_WIDE_SENTENCE, _WIDE_CLAUSE = "。！？｡", "，；：、"


def _lines(piece: str) -> int:
    """Line ends in white space; a paragraph separator counts as two."""
    return piece.count("\n") + piece.count("\r") - piece.count("\r\n") + piece.count("\u2028") + 2 * piece.count("\u2029")


@lru_cache(maxsize=200_000)
def _ending(piece: str) -> tuple[int, int]:
    """Strength of a boundary after this pre-token, as such and if white space follows."""
    last = piece[-1]
    if last in _WIDE_SENTENCE:
        return 4, 4
    if last in _WIDE_CLAUSE:
        return 3, 3
    if last.isspace():
        return 2, 2
    return 1, 4 if last in _SENTENCE else 3 if last in _CLAUSE else 2


def boundaries(pieces: list[str], ids: list[list[int]], get: Encoder, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Token positions at which a text may be cut, and their strengths; inside only of pre-tokens of more than ``longest`` tokens."""
    count = np.fromiter(map(len, ids), np.int64, len(ids))
    end = np.cumsum(count)
    blank = [p[0].isspace() for p in pieces[1:]]
    strength = np.fromiter((_ending(p)[b] for p, b in zip(pieces, blank)), np.int8, len(pieces) - 1)
    lines = 0
    for k, p in enumerate(pieces[:-1]):  # white space in several pre-tokens is one boundary, behind its last
        if not p.isspace():
            lines = 0
            continue
        lines += _lines(p)
        if pieces[k + 1].isspace():
            strength[k] = 1
        elif lines:
            strength[k] = 6 if lines > 1 else 5
    position = end[:-1]
    inner_at, inner = [], []
    for k in np.flatnonzero(count > longest):
        start = end[k] - count[k]
        inner_at.append(np.arange(start + 1, end[k]))
        inner.append(np.fromiter((0 if get.table[t][0] & 0xC0 != 0x80 else -1 for t in ids[k][1:]), np.int8, count[k] - 1))
    if inner:
        position = np.concatenate([position, *inner_at])
        strength = np.concatenate([strength, *inner])
        order = np.argsort(position, kind="stable")
        position, strength = position[order], strength[order]
    return position, strength


def bisect(n: int, position: np.ndarray, strength: np.ndarray, most: int) -> list[int]:
    """Cuts (0, ..., n) so that no part exceeds ``most`` tokens."""
    cuts, todo = [0, n], [(0, n)]
    while todo:
        a, b = todo.pop()
        if b - a <= most:
            continue
        quarter, middle = (b - a) / 4, (a + b) / 2
        i, j = np.searchsorted(position, [a + quarter, b - quarter])
        if i >= j:  # no place in the middle half: the nearest to the midpoint inside the stretch
            i, j = np.searchsorted(position, a, "right"), np.searchsorted(position, b)
            k = i + int(np.argmin(np.abs(position[i:j] - middle)))
        else:
            s = strength[i:j]
            best = np.flatnonzero(s == s.max())
            k = i + int(best[np.argmin(np.abs(position[i:j][best] - middle))])
        c = int(position[k])
        cuts.append(c)
        todo += [(a, c), (c, b)]
    return sorted(cuts)


def readable(piece: bytes) -> str:
    """A piece's text from its first whole character on."""
    start = next((k for k, b in enumerate(piece[:4]) if b & 0xC0 != 0x80), 0)
    return piece[start:].decode("utf-8", "replace")


def split(
    documents: DataFrame, limit: int = 1024, overlap: int = 64, id_column: str = "doc_id", text_column: str = "text",
    tokenizer: str = "byte_bpe_50k", folder: str | None = None, short: bool = False, contents: bool = True,
) -> DataFrame:
    """(id, piece, n_pieces, start, n_tokens, n_overlap[, ids, text]): the pieces of every text of more than ``limit`` tokens.

    ``start`` is the piece's first own token; its first ``n_overlap`` tokens are the last of the piece before.  The ids of
    all pieces without their overlaps, joined, are the ids of the text.  ``text`` is the piece's bytes as UTF-8; where an
    overlap begins inside a character, from the next character on (``ids`` has all of it).  With ``short`` other texts come as one piece too;
    without ``contents`` the last two columns are left out.  Null and empty texts have no pieces; repeated rows
    are split each; no shuffle, other columns are not read.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    path, id_type, most = rank_file(tokenizer, folder), dict(documents.dtypes)[id_column], limit - overlap
    longest = min(64, most // 2)  # a stretch of more than ``most`` tokens has a place to cut
    names = [id_column, "piece", "n_pieces", "start", "n_tokens", "n_overlap", *(["ids", "text"] if contents else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = encoder(path)
        for batch in batches:
            for first, texts in text_slices(batch.column(1)):
                rows, numbers, lists, strings = [], [], [], []
                for k, text in enumerate(texts):
                    # A token has at least one byte.
                    if not text or (not short and len(text) * 4 <= limit) or (not short and len(text) <= limit and len(text.encode("utf-8", "replace")) <= limit):
                        continue
                    pieces = get.cut(text)
                    ids = [get.memo[p] for p in pieces]
                    n = sum(map(len, ids))
                    if n <= limit and not short:
                        continue
                    flat = list(chain.from_iterable(ids))
                    cuts = [0, n] if n <= limit else bisect(n, *boundaries(pieces, ids, get, longest), most)
                    for m, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        back = min(overlap, a)
                        rows.append(first + k)
                        numbers.append((m, len(cuts) - 1, a, b - a + back, back))
                        if contents:
                            own = flat[a - back : b]
                            lists.append(own)
                            strings.append(readable(b"".join([get.table[t] for t in own])))
                columns = [pa.array([r[c] for r in numbers], pa.int32()) for c in range(5)]
                if contents:
                    columns += [pa.array(lists, pa.list_(pa.int32())), pa.array(strings, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], names=names)

    narrow = documents.select(id_column, documents[text_column].cast("string").alias("text"))
    more = ", ids array<int>, text string" if contents else ""
    return narrow.mapInArrow(run, f"`{id_column}` {id_type}, piece int, n_pieces int, start int, n_tokens int, n_overlap int{more}")


def oversized(documents: DataFrame, **kwargs) -> DataFrame:
    """(doc_id) of the documents that had to be split: those that have a second piece."""
    return split(documents, contents=False, **kwargs).filter("piece = 1").select("doc_id").distinct()
