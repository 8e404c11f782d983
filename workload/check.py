"""Compare the registered queries with their SQL twins: ``python -m workload.check [folder] [name ...]``."""

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from beatline.session import build_session
from workload import catalog, oracle

TABLES = ["events"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _bag(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, db, name: str, sf_dir: str) -> list[str]:
    """What differs in column names, number types or rows; nothing if all agrees."""
    result = catalog.queries()[name](spark, sf_dir)
    rows = [tuple(row) for row in result.collect()]
    statement = oracle.statements().get(name)
    if statement is None:
        return [] if rows else ["no rows"]
    expected = db.execute(statement)
    names = [d[0] for d in expected.description]
    expected_rows = expected.fetchall()
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} against {sorted(names)}"]
    found = []
    kinds = {d[0]: str(d[1]).lower() for d in expected.description}
    simple = {"int": "integer", "bigint": "bigint", "double": "double", "boolean": "boolean", "string": "varchar"}
    types = dict(zip(names, [str(t).lower() for t in db.sql(statement).types]))
    for column, kind in result.dtypes:
        if kind in simple and types[column] != simple[kind]:
            found.append(f"{column} is {kind} against {types[column]} ({kinds[column]})")
    ours = _bag(rows, [result.columns.index(c) for c in sorted(names)])
    theirs = _bag(expected_rows, [names.index(c) for c in sorted(names)])
    if ours != theirs:
        found.append(
            f"{len(rows)} rows against {len(expected_rows)}; only here {list((ours - theirs).items())[:3]}; "
            f"only there {list((theirs - ours).items())[:3]}"
        )
    return found


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    for name in names or catalog.queries():
        start = time.time()
        try:
            found = differences(spark, db, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else "", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
