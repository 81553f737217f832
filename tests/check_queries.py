"""Run registered queries beside their SQL in DuckDB and compare the results.

Usage: python tests/check_queries.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = Path("/root/testdata")
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    with duckdb.connect() as db:
        for file in Path(sf_dir).glob("*.parquet"):
            db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = db.execute(sql)
        names = [column[0] for column in result.description]
        types = {column[0]: str(column[1]).upper() for column in result.description}
        order = sorted(range(len(names)), key=lambda i: names[i])
        rows = Counter(tuple(repr(row[i]) for i in order) for row in result.fetchall())
    return [f"{name} {types[name]}" for name in sorted(names)], rows


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    kinds = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    # Nested columns occur in queries without SQL only; they keep Spark's name.
    types = {name: SQL_TYPES.get(kind, kind) for name, kind in kinds.items()}
    rows = Counter(tuple(repr(v) for v in row) for row in df.select(names).collect())
    return [f"{name} {types[name]}" for name in names], rows


def compare(spark: SparkSession, sf_dir: str, function, sql: str | None) -> str:
    """Empty when equal, else what differs."""
    names, rows = spark_rows(function(spark, sf_dir))
    if not rows:
        return "no rows"
    if sql is None:
        return ""
    wanted_names, wanted = oracle_rows(sf_dir, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if rows != wanted:
        extra, lacking = rows - wanted, wanted - rows
        return (
            f"{rows.total()} rows, {wanted.total()} wanted; "
            f"extra {extra.total()}: {list(extra)[:2]}; lacking {lacking.total()}: {list(lacking)[:2]}"
        )
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__

    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in args.names or queries:
        start = time.time()
        try:
            problem = compare(spark, f"{DATA}/sf{args.sf}", queries[name], oracles.get(name))
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in oracles else "rows"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:28} {kind:4} {time.time() - start:6.2f}s {problem}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
