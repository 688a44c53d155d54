"""python -m lightloom list | run NAME FOLDER OUT | sql FOLDER 'SELECT ...': queries over a folder of tables."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="lightloom")
    verbs = parser.add_subparsers(dest="verb", required=True)
    verbs.add_parser("list", help="names of the queries")
    run = verbs.add_parser("run", help="one query over a folder of tables, written as Parquet or CSV")
    run.add_argument("name")
    run.add_argument("folder")
    run.add_argument("out")
    run.add_argument("--csv", action="store_true")
    sql = verbs.add_parser("sql", help="one reading statement over the tables of a folder")
    sql.add_argument("folder")
    sql.add_argument("text")
    given = parser.parse_args(arguments)
    from lightloom.plans import choice, loading, more, quality, registry, search, series  # noqa: F401 - they register their queries

    queries = registry.QUERIES | quality.QUERIES
    if given.verb == "list":
        print("\n".join(sorted(queries)))
        return 0
    spark = SparkSession.builder.getOrCreate()
    if given.verb == "run":
        if given.name not in queries:
            parser.error(f"no query {given.name}")
        rows = queries[given.name](spark, given.folder)
        search.write_csv(rows, given.out) if given.csv else rows.write.mode("overwrite").parquet(given.out)
        return 0
    for p in sorted(Path(given.folder).glob("*.parquet")):
        spark.read.parquet(str(p)).createOrReplaceTempView(p.stem)
    rows, cut = search.run_sql(spark, given.text)
    rows.show(search.MOST_ROWS, truncate=False)
    print(f"the first {search.MOST_ROWS} rows" if cut else "all rows")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
