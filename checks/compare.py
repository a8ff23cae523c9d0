"""Run queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from .oracles import ORACLES
from .queries import QUERIES


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, v) for v in row)


def differences(result: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a result and its SQL, empty when nothing does."""
    relation = db.sql(sql)
    columns = sorted(result.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} / {sorted(relation.columns)}"]
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    found = [f"type of {c}: {t} / {theirs[c]}" for c, t in result.dtypes if names.get(t, t) != theirs[c]]
    left = sorted((tuple(r) for r in result.select(*(f"`{c}`" for c in columns)).collect()), key=_sortable)
    right = sorted(relation.select(*(f'"{c}"' for c in columns)).fetchall(), key=_sortable)
    if len(left) != len(right):
        return [*found, f"rows {len(left)} / {len(right)}"]
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        found.append(f"{len(wrong)} of {len(left)} rows differ, first {str(wrong[0])[:300]}")
    if any(isinstance(v, float) and math.isnan(v) for row in left for v in row):
        found.append("NaN in result")
    return found


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = database(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        result = QUERIES[name](spark, sf_dir)
        if name in ORACLES:
            found = differences(result, db, ORACLES[name])
            outcome = "; ".join(found) or "equal"
            failed += bool(found)
        else:
            outcome = f"{result.count()} rows, no SQL"
        print(f"{name:24} {time.time() - start:7.2f} s  {outcome}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
