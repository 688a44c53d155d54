"""Reading source catalogues from FITS files: the primary header and the first binary table, nothing else.

Image extensions are skipped by their size, never read.  Paths are spread over tasks; each task opens its own files on
storage that all executors share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

#: A FITS file is made of blocks of 2880 bytes, a header of cards of 80; column formats and their types.
BLOCK, CARD = 2880, 80
FORMATS = {"L": "S1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8", "A": "S"}


def _value(card: str) -> object:
    text = card[10:].strip()
    if text.startswith("'"):
        out, k = "", 1
        while k < len(text):
            if text[k] == "'":
                if text[k + 1 : k + 2] != "'":
                    break
                k += 1
            out += text[k]
            k += 1
        return out.rstrip()
    text = text.split("/")[0].strip()
    if text in ("T", "F"):
        return text == "T"
    for kind in (int, lambda x: float(x.replace("D", "E"))):
        try:
            return kind(text)
        except ValueError:
            pass
    return text or None


def read_header(f) -> dict[str, object] | None:
    """The next header of an open file, which then stands at its data; None at the end."""
    out: dict[str, object] = {}
    while True:
        block = f.read(BLOCK)
        if len(block) < BLOCK:
            return None
        for k in range(0, BLOCK, CARD):
            card = block[k : k + CARD].decode("ascii", "replace")
            if card.startswith("END") and not card[3:8].strip():
                return out
            if card[8:10] == "= ":
                out.setdefault(card[:8].strip(), _value(card))


def data_size(h: dict[str, object]) -> int:
    n = int(h.get("NAXIS", 0) or 0)
    if not n:
        return 0
    cells = math.prod(int(h[f"NAXIS{k + 1}"]) for k in range(n))
    size = abs(int(h["BITPIX"])) // 8 * int(h.get("GCOUNT", 1) or 1) * (int(h.get("PCOUNT", 0) or 0) + cells)
    return -(-size // BLOCK) * BLOCK


def read_table(path: str) -> tuple[dict[str, object], np.ndarray]:
    """(primary header, records of the first binary table)."""
    with open(path, "rb") as f:
        primary = read_header(f)
        if primary is None:
            raise ValueError(f"{path}: no FITS header")
        f.seek(data_size(primary), 1)
        while (h := read_header(f)) is not None:
            if h.get("XTENSION") != "BINTABLE":
                f.seek(data_size(h), 1)
                continue
            fields = []
            for k in range(1, int(h["TFIELDS"]) + 1):
                form = str(h[f"TFORM{k}"]).strip()
                digits = len(form) - len(form.lstrip("0123456789"))
                repeat, code = int(form[:digits] or 1), form[digits]
                if code not in FORMATS:
                    raise ValueError(f"{path}: column format {form}")
                name = str(h.get(f"TTYPE{k}", f"col{k}"))
                fields.append((name, f"S{repeat}") if code == "A" else (name, FORMATS[code], (repeat,)) if repeat != 1 else (name, FORMATS[code]))
            kind, rows = np.dtype(fields), int(h["NAXIS2"])
            if kind.itemsize != int(h["NAXIS1"]):
                raise ValueError(f"{path}: rows of {h['NAXIS1']} bytes, columns of {kind.itemsize}")
            return primary, np.frombuffer(f.read(rows * kind.itemsize), kind, rows)
    raise ValueError(f"{path}: no binary table")


#: Our column: theirs.  Fluxes may be vectors, one value per aperture.
COLUMNS = {"ra": "ALPHA_J2000", "dec": "DELTA_J2000", "x": "X_IMAGE", "y": "Y_IMAGE", "flux": "FLUX_APER", "fluxerr": "FLUXERR_APER", "flags": "FLAGS"}


def read_fits_sources(spark: SparkSession, paths: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """(path, source, ra, dec, x, y, flux[], fluxerr[], flags) of every source with a finite place; NaN as null elsewhere."""
    names = COLUMNS | (columns or {})
    listed = spark.createDataFrame([(p,) for p in dict.fromkeys(paths)], "path string").repartition(max(1, min(len(paths), 10_000)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                _, t = read_table(path)
                missing = [v for v in names.values() if v not in (t.dtype.names or ())]
                if missing:
                    raise ValueError(f"{path}: no such columns: {', '.join(missing)}")
                out = {"path": path, "source": np.arange(len(t), dtype=np.int64)}
                for ours, theirs in names.items():
                    v = t[theirs].astype(t[theirs].dtype.newbyteorder("="))
                    out[ours] = list(v.reshape(len(t), -1).astype(float)) if ours in ("flux", "fluxerr") else v.astype(np.int32 if ours == "flags" else float)
                df = pd.DataFrame(out)
                yield df[np.isfinite(df["ra"]) & np.isfinite(df["dec"])]

    return listed.mapInPandas(run, "path string, source long, ra double, dec double, x double, y double, flux array<double>, fluxerr array<double>, flags int")


def read_fits_headers(spark: SparkSession, paths: list[str], keys: tuple[str, ...] = ("DATE-OBS", "EXPTIME", "AIRMASS", "FILTER", "OBJECT", "TELESCOP")) -> DataFrame:
    """(path, header): the primary header's cards of these keys as text; absent ones are not in the map."""
    listed = spark.createDataFrame([(p,) for p in dict.fromkeys(paths)], "path string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with open(path, "rb") as f:
                    h = read_header(f) or {}
                rows.append({"path": path, "header": {k: str(h[k]) for k in keys if h.get(k) is not None}})
            yield pd.DataFrame(rows, columns=["path", "header"])

    return listed.mapInPandas(run, "path string, header map<string,string>")
