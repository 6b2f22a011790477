"""Run registered queries against their SQL counterparts: ``python -m checks.compare sf_dir [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from checks.oracles import oracle_sql
from checks.queries import queries
from tallyline import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Names of the same type on both sides.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a result and its counterpart; empty when they are the same."""
    expected = connection.execute(sql)
    wanted_types = {d[0]: str(d[1]) for d in expected.description}
    wanted_rows = expected.fetchall()
    found_types = {name: TYPES.get(kind, kind.upper()) for name, kind in df.dtypes}
    problems = [
        f"{name}: {found_types.get(name)} against {wanted_types.get(name)}"
        for name in sorted({*found_types, *wanted_types}) if found_types.get(name) != wanted_types.get(name)
    ]
    if set(found_types) != set(wanted_types):
        return problems
    columns = sorted(found_types)
    order = [list(wanted_types).index(c) for c in columns]
    found = Counter(tuple(r) for r in df.select(*columns).collect())
    wanted = Counter(tuple(r[i] for i in order) for r in wanted_rows)
    if found != wanted:
        problems.append(
            f"rows: {found.total()} against {wanted.total()}; only here {list((found - wanted).items())[:2]}; "
            f"only in SQL {list((wanted - found).items())[:2]}",
        )
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, oracles, connection, failed = queries(), oracle_sql(), connect(sf_dir), 0
    for name in names or registered:
        begin = time.time()
        if name not in oracles:
            found, problems = registered[name](spark, sf_dir).count(), []
        else:
            df = registered[name](spark, sf_dir)
            problems = differences(df, connection, oracles[name])
            found = "same" if not problems else "DIFFERS"
        failed += bool(problems)
        print(f"{name:34} {time.time() - begin:6.2f}s  {found}", *problems, sep="\n    ", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
