"""Changes of the store as plans from old and new rows to the new version of a table, and their idempotent writing.

Parquet has no MERGE, so each operation gives the whole new version, or the partitions that change.  ``publish`` writes a
version to a folder of its own and then moves one pointer to it, so readers (``published``) see one version or the other;
doing it again changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; the others stay.  Columns by name; absent ones null."""
    kept = old.join(new.select(*key).distinct(), key, "left_anti").select(*old.columns)
    return kept.unionByName(new, allowMissingColumns=True)


def with_surrogate(old: DataFrame, new: DataFrame, key: list[str], surrogate: str, buckets: int = 1024) -> DataFrame:
    """``new`` with the surrogate ids that its keys already have; further keys are numbered on from the greatest.

    Fresh keys are numbered within hash buckets and the buckets' sizes added up, so no task sees all of them and a
    recomputation numbers them alike.  Keys should be unique in ``new``.
    """
    known = new.join(old.select(*key, surrogate), key, "left")
    most = old.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0]
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))
    fresh = known.filter(F.col(surrogate).isNull()).drop(surrogate).withColumn("__b", bucket)
    sizes = fresh.groupBy("__b").agg(F.count("*").alias("__n"))  # a row per bucket at most
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__b", (before + most).alias("__start"))
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(*key))
    numbered = fresh.withColumn("__r", rank).join(F.broadcast(starts), "__b")
    numbered = numbered.withColumn(surrogate, (F.col("__start") + F.col("__r")).cast("long")).drop("__b", "__r", "__start")
    return known.filter(F.col(surrogate).isNotNull()).unionByName(numbered)


def reload(old: DataFrame, new: DataFrame, part: str, replaced: Column | None = None) -> DataFrame:
    """All rows of the parts (nights) that ``new`` holds are replaced, or of them those for which ``replaced`` holds."""
    parts = new.select(part).distinct().withColumn("__new", F.lit(True))
    tagged = old.join(parts, part, "left")
    gone = F.col("__new").isNotNull() & (F.lit(True) if replaced is None else F.coalesce(replaced, F.lit(False)))
    return tagged.filter(~gone).drop("__new").unionByName(new, allowMissingColumns=True)


def cascade(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """The child rows whose parent is still there (null keys stay): what ON DELETE CASCADE leaves."""
    live = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return child.filter(F.col(key).isNull()).unionByName(child.filter(F.col(key).isNotNull()).join(live, key, "left_semi").select(*child.columns))


def unreferenced(parent: DataFrame, key: str, children: list[tuple[DataFrame, str]], guard: Column | None = None) -> DataFrame:
    """Parents that no child table refers to and that nothing else protects: those to drop."""
    left = parent if guard is None else parent.filter(guard)
    for rows, column in children:
        left = left.join(rows.select(F.col(column).alias(key)).distinct(), key, "left_anti")
    return left


def fill(old: DataFrame, new: DataFrame, key: str, columns: list[str], only_null: bool = True) -> DataFrame:
    """Columns of ``old`` set from ``new`` by key; only where they are null, or wherever ``new`` has a value."""
    right = new.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = old.join(right, key, "left")
    values = {c: F.coalesce(F.col(c), F.col(f"__{c}")) if only_null else F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}
    return joined.withColumns(values).select(*old.columns)


def swap_write(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Writes a table at a plain path: beside the old one, then exchanged by two renames, between which there is none.

    With ``partition`` only the partitions in ``df`` are replaced (dynamic overwrite).  See ``publish`` for readers that go on.
    """
    spark = df.sparkSession
    if partition:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        return
    jvm, fresh, former = spark._jvm, path.rstrip("/") + ".new", path.rstrip("/") + ".old"
    df.write.mode("overwrite").parquet(fresh)
    as_path = jvm.org.apache.hadoop.fs.Path
    fs = as_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(as_path(former), True)
    if fs.exists(as_path(path)):
        fs.rename(as_path(path), as_path(former))
    fs.rename(as_path(fresh), as_path(path))
    fs.delete(as_path(former), True)


POINTER = "_current"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and what turns names under it into its paths."""
    root, at = path.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
    return at(root).getFileSystem(spark._jsc.hadoopConfiguration()), lambda name: at(f"{root}/{name}")


def version_of(spark: SparkSession, path: str) -> str | None:
    """The name of the published version's folder; None where nothing is published."""
    fs, at = _files(spark, path)
    if not fs.exists(at(POINTER)):
        return None
    stream = fs.open(at(POINTER))
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def published(spark: SparkSession, path: str) -> DataFrame | None:
    name = version_of(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/{name}") if name else None


def publish(df: DataFrame, path: str) -> None:
    """Makes ``df`` the table's version: written whole first, then the pointer is replaced by one atomic rename.

    The version before stays for readers that have begun; older ones are removed.
    """
    spark, name = df.sparkSession, f"v-{uuid.uuid4().hex}"
    fs, at = _files(spark, path)
    before = version_of(spark, path)
    df.write.parquet(f"{path.rstrip('/')}/{name}")
    stream = fs.create(at(f"{POINTER}.{name}"), True)
    stream.write(bytearray(name.encode()))
    stream.close()
    jvm = spark._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(at(f"{POINTER}.{name}"), at(POINTER), over)
    for found in fs.listStatus(at("")):
        if found.getPath().getName().startswith("v-") and found.getPath().getName() not in (name, before):
            fs.delete(found.getPath(), True)
