"""Readers of tables: Parquet with optional columns, column maps, text catalogues, expanded lists of inputs."""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, *paths: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Parquet files with different columns as one table; ``columns`` (name: type) that no file has are null.

    Only the named columns are read.
    """
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    if columns is None:
        return df
    return df.select(*(F.col(n).cast(k).alias(n) if n in df.columns else F.lit(None).cast(k).alias(n) for n, k in columns.items()))


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A catalogue if it is there, else an empty one: a missing catalogue matches nothing."""
    return spark.read.parquet(path) if glob.glob(path) else empty(spark, schema)


def map_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Columns by other names (ours: theirs); a missing one is an error that names it."""
    missing = [theirs for theirs in columns.values() if theirs not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df.select(*(F.col(theirs).alias(ours) for ours, theirs in columns.items()))


def first_present(df: DataFrame, name: str, candidates: list[str]) -> DataFrame:
    """A column made of the first of the candidates that exists and is not null."""
    there = [F.col(x) for x in candidates if x in df.columns]
    return df.withColumn(name, F.coalesce(*there) if there else F.lit(None).cast("string"))


def expand_inputs(arguments: list[str]) -> list[str]:
    """Paths, patterns and @lists (one path a line, # comments) as paths; each once, in order."""
    out: list[str] = []
    for a in arguments:
        if a.startswith("@"):
            with open(a[1:]) as lines:
                out += expand_inputs([x.strip() for x in lines if x.strip() and not x.lstrip().startswith("#")])
        else:
            out += sorted(glob.glob(a)) or [a]
    return list({os.path.realpath(p): p for p in reversed(out)}.values())[::-1]


def read_csv_catalog(spark: SparkSession, path: str, apertures: str = "FLUX_APER", errors: str = "FLUXERR_APER") -> DataFrame:
    """A text catalogue; columns NAME_1 ... NAME_n become arrays, their number is found from the header."""
    df = spark.read.option("header", True).option("inferSchema", False).option("comment", "#").csv(path)
    arrays = {}
    for out, stem in (("flux", apertures), ("fluxerr", errors)):
        n = 0
        while f"{stem}_{n + 1}" in df.columns:
            n += 1
        names = [f"{stem}_{k + 1}" for k in range(n)] or ([stem] if stem in df.columns else [])
        arrays[out] = F.array(*(F.col(x).try_cast("double") for x in names)).cast("array<double>")
    rest = [x for x in df.columns if not x.startswith((apertures, errors))]
    return df.select(*(F.col(x).try_cast("double").alias(x) for x in rest), *(v.alias(k) for k, v in arrays.items()))
