"""Run registered queries beside their SQL counterparts in DuckDB and compare every value.

    python -m tests.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import time
from decimal import Decimal

import duckdb

import __spark_entry__ as driver
from subscope.settings import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

PAIR_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
_KIND = {
    "HUGEINT": "int", "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "string",
    "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "bool",
}
_SPARK_KIND = {
    "bigint": "int64", "int": "int32", "double": "float64", "string": "string", "date": "date",
    "timestamp_ntz": "timestamp", "timestamp": "timestamp", "boolean": "bool",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, str(v) if not isinstance(v, float) else f"{v:.9e}") for v in row)


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """What differs between the two results; empty when nothing does."""
    df = driver.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if any(join in plan for join in PAIR_JOINS):
        return ["the plan joins all pairs of rows"]
    ours = [tuple(r) for r in df.select(*columns).collect()]
    if name not in driver.oracle_sql():
        return [] if ours else ["no rows"]
    cursor = con.execute(f"SELECT * FROM ({driver.oracle_sql()[name]}) AS o")
    theirs_types = {d[0]: str(d[1]).upper() for d in cursor.description}
    if sorted(theirs_types) != columns:
        return [f"columns {columns} and {sorted(theirs_types)}"]
    order = [d[0] for d in cursor.description]
    theirs = [tuple(row[order.index(c)] for c in columns) for row in cursor.fetchall()]
    problems = []
    for field in df.schema.fields:
        found = theirs_types[field.name]
        ours_kind = _SPARK_KIND.get(field.dataType.simpleString(), field.dataType.simpleString())
        theirs_kind = _KIND.get(found, found.lower().replace("double", "float64"))
        if found != "NUMBER" and ours_kind != theirs_kind:
            problems.append(f"type of {field.name}: {ours_kind} and {theirs_kind}")
    if len(ours) != len(theirs):
        return problems + [f"{len(ours)} rows and {len(theirs)}"]
    for mine, other in zip(sorted(ours, key=_sortable), sorted(theirs, key=_sortable)):
        for column, a, b in zip(columns, mine, other):
            if not _same(a, b):
                problems.append(f"{column}: {a!r} and {b!r}")
                if len(problems) > 5:
                    return problems
    return problems


def _same(a: object, b: object) -> bool:
    if isinstance(a, Decimal) and isinstance(b, Decimal):
        return a == b
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = local_session(), connect(args.sf)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in args.names or driver.queries():
        start = time.time()
        try:
            problems = differences(spark, con, name, args.sf)
        except Exception as error:  # report and go on to the next query
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        checked = "sql" if name in driver.oracle_sql() else "rows"
        print(f"{'BAD' if problems else 'ok ':3} {name:32} {checked:5} {time.time() - start:6.2f}s", *problems, sep="\n      " if problems else " ", flush=True)
    print(f"{bad} of {len(args.names or driver.queries())} differ")


if __name__ == "__main__":
    main()
