"""Run registered queries beside their SQL and compare whole results.

    python tests/compare.py <folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def mismatch(frame, relation) -> str | None:
    """None if both results hold the same columns, kinds and rows."""
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} / {sorted(relation.columns)}"
    same = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    for field in frame.schema.fields:
        wanted = same.get(field.dataType.simpleString())
        if wanted != kinds[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} / {kinds[field.name]}"
    ours = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, chosen = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle = connect(folder), entry.oracle_sql()
    failed = 0
    for name, run in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            frame = run(spark, folder)
            if name not in oracle:
                verdict = f"no SQL, {frame.count()} rows"
            else:
                problem = mismatch(frame, connection.sql(oracle[name]))
                verdict = "ok" if problem is None else f"MISMATCH {problem}"
                failed += problem is not None
        except Exception as error:  # noqa: BLE001
            failed += 1
            verdict = f"ERROR {str(error)[:600]}"
        print(f"{name:34s} {time.time() - start:6.2f}s {verdict}", flush=True)
    missing = [n for n in oracle if n not in entry.queries()]
    print("failed:", failed, "SQL without query:", missing)


if __name__ == "__main__":
    main()
