"""Products of a night: named tables and the settings that made them, written and read together, and reports of them as CSV."""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_product(tables: dict[str, DataFrame], path: str, settings: dict) -> None:
    """Each table as Parquet under a folder; the settings are a table of one row beside them, written last, so a product with settings is whole."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    row = spark.createDataFrame([(json.dumps(settings, sort_keys=True), sorted(tables))], "settings string, tables array<string>")
    row.coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def read_product(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    """(tables by name, settings) of a product; one that was not finished is an error of the reader."""
    row = spark.read.json(f"{path}/settings").first()
    return {name: spark.read.parquet(f"{path}/{name}") for name in row["tables"]}, json.loads(row["settings"])


def disagreements(products: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, one count a product): keys whose products have different numbers of rows; none if they belong together."""
    out = None
    for name, df in products.items():
        n = df.groupBy(key).agg(F.count("*").alias(name))
        out = n if out is None else out.join(n, key, "full")
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in products]
    return out.select(key, *counts).filter(F.greatest(*products) != F.least(*products)) if len(products) > 1 else out.limit(0)


def the_one(folder: str, ending: str) -> str:
    """The only path of a folder with an ending; none or several are an error."""
    found = sorted(glob.glob(os.path.join(folder, f"*{ending}")))
    if len(found) != 1:
        raise ValueError(f"{len(found)} of *{ending} in {folder}, one is needed")
    return found[0]


def companion(path: str, endings: tuple[str, ...] = (".fits", ".fit", ".fits.fz")) -> str:
    """The file with a text catalogue's header: of the same name with another ending; other paths are their own."""
    stem, ending = os.path.splitext(path)
    if ending.lower() not in (".csv", ".cat", ".txt"):
        return path
    for e in endings:
        if os.path.exists(stem + e):
            return stem + e
    raise ValueError(f"no header beside {path}")


def write_report(df: DataFrame, path: str, *order: str) -> None:
    """A report as one CSV file with a header, in an order; for tables of a size that a person reads."""
    (df.orderBy(*order) if order else df).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
