"""Byte-level BPE encoding of whole corpora with a published rank file.

Method: a text is cut into pre-tokens by the tokenizer's own pattern.  Within a pre-token a segment tree over
byte positions stores the leftmost minimum pair rank; its root names the next merge, and a merge is
three logarithmic point updates (the merged pair, its live left neighbour, the position that disappears), so
a pre-token of n bytes costs O(n log n) however long it is.  Short pre-tokens are memoised per worker.

Defined results: null and empty texts give the empty list; look-alikes of special tokens are ordinary text;
unpaired surrogates cannot occur in Arrow strings and, given through Python, count as U+FFFD.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Folder of the vocabulary files; a parameter of every operator, this is its default.
TOKENIZERS = os.environ.get("LIGHTLOOM_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the pre-token pattern published with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens up to so many characters are memoised; the memo is emptied when it holds MEMO_SIZE of them.
MEMO_CHARS, MEMO_SIZE = 48, 300_000
#: Texts of one Arrow batch are encoded in slices of about so many bytes, to bound a worker's memory.
SLICE_BYTES = 8 << 20

#: A pair that no merge makes, and the least value of a node that holds none.
_NONE = 1 << 30
_DEAD = _NONE << 32

#: White space of the pattern (Unicode's White_Space), as ranges.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(member, last: int) -> str:
    """A regular expression's class of all code points up to ``last`` with the property."""
    import re
    from itertools import groupby

    runs = [list(g) for yes, g in groupby(range(last + 1), member) if yes]
    return "".join(f"{re.escape(chr(r[0]))}-{re.escape(chr(r[-1]))}" if r[1:] else re.escape(chr(r[0])) for r in runs)


def fast_pattern(last: int):
    """PATTERN for texts of code points up to ``last``, with its classes written out for the faster ``re``."""
    import re

    import regex

    letter, digit = regex.compile(r"\p{L}").match, regex.compile(r"\p{N}").match
    l, d = (_ranges(lambda c, f=f: bool(f(chr(c))), last) for f in (letter, digit))
    s = _SPACE if last > 127 else "\\t-\\r "
    # The elisions may follow the letters' alternative: none begins with a letter or space.
    return re.compile(f" ?[{l}]+|'(?:s|t|re|ve|m|ll|d)| ?[{d}]+| ?[^{s}{l}{d}]+|[{s}]+(?![^{s}])|[{s}]+")




def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id of a rank file (one ``base64 rank`` pair a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: repeated merges of the leftmost pair of least rank, found at the tree's root."""
    n = len(piece)
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    rank_of = ranks.get
    part = [piece[i : i + 1] for i in range(n)]
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1 << max(1, (n - 2).bit_length())
    # A node holds rank * 2**32 + position, so the least value is the leftmost pair of least rank.
    tree = [_DEAD] * (2 * size)
    tree[size : size + n - 1] = [rank_of(piece[i : i + 2], _NONE) << 32 | i for i in range(n - 1)]
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    while tree[1] < _DEAD:
        i = tree[1] & 0xFFFFFFFF
        j = right[i]
        part[i] += part[j]
        part[j] = b""
        h, k = left[i], right[j]
        right[i] = k
        # Point updates of the vanished position, the merged pair and its live left neighbour.
        changed = [(size + j, _DEAD)] if j < n - 1 else []
        if k < n:
            left[k] = i
            changed.append((size + i, rank_of(part[i] + part[k], _NONE) << 32 | i))
        else:
            changed.append((size + i, _DEAD))
        if h >= 0:
            changed.append((size + h, rank_of(part[h] + part[i], _NONE) << 32 | h))
        for node, value in changed:
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    break
                tree[node] = value
    return [ranks[x] for x in part if x]


class Memo(dict):
    """Pre-token -> ids, computed on first use; bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> list[int]:
        ids = merge(piece.encode("utf-8", "replace"), self.ranks)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_SIZE:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts; one per worker process and rank file (see ``encoder``)."""

    def __init__(self, path: str):
        import re

        import regex

        self.ranks = read_ranks(path)
        self.memo = Memo(self.ranks)
        self._any = regex.compile(PATTERN).findall
        self._ascii, self._basic = (fast_pattern(last).findall for last in (0x7F, 0xFFFF))
        self._beyond = re.compile("[\U00010000-\U0010ffff]").search

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text; joined they are the text."""
        if text.isascii():
            return self._ascii(text)
        return self._any(text) if self._beyond(text) else self._basic(text)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; [] for None and ''."""
        return list(chain.from_iterable(map(self.memo.__getitem__, self.cut(text)))) if text else []

    @cached_property
    def table(self) -> dict[int, bytes]:
        """Bytes of each id."""
        return {i: b for b, i in self.ranks.items()}


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def rank_file(tokenizer: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return os.path.join(folder or TOKENIZERS, f"{tokenizer}.tiktoken")


def text_slices(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(start row, texts) of runs of rows holding about SLICE_BYTES together; at least one row each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    cell = np.cumsum(sizes) // SLICE_BYTES
    starts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(column)] if len(column) else [0]
    for a, b in zip(starts, starts[1:]):
        yield a, column.slice(a, b - a).to_pylist()


def encode_corpus(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str = "byte_bpe_50k",
    folder: str | None = None, lists: bool = True,
) -> DataFrame:
    """One row per document row: the id and ``ids`` (array<int>), or only ``n_tokens`` if not ``lists``.

    A narrow transformation: no shuffle, nothing collected, nothing broadcast; workers read the rank file
    themselves.  The scan's partitions are the tasks, at every size: one file of one row group is one task.  Only the two named columns are read, so further columns of any name do no harm.  Null ids
    are kept, repeated rows are encoded each, an empty table gives an empty table.
    """
    path = rank_file(tokenizer, folder)
    id_type = dict(documents.dtypes)[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = encoder(path)
        for batch in batches:
            for start, texts in text_slices(batch.column(1)):
                encoded = [get.encode(x) for x in texts]
                count = np.fromiter(map(len, encoded), np.int32, len(encoded))
                key = batch.column(0).slice(start, len(texts))
                if not lists:
                    yield pa.RecordBatch.from_arrays([key, pa.array(count)], names=[id_column, "n_tokens"])
                    continue
                offsets = np.concatenate([[0], np.cumsum(count, dtype=np.int64)]).astype(np.int32)
                flat = np.fromiter(chain.from_iterable(encoded), np.int32, int(offsets[-1]))
                yield pa.RecordBatch.from_arrays(
                    [key, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_column, "ids"]
                )

    narrow = documents.select(id_column, documents[text_column].cast("string").alias("text"))
    return narrow.mapInArrow(run, f"`{id_column}` {id_type}, " + ("ids array<int>" if lists else "n_tokens int"))
