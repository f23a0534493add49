"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels " \
         "conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    """A form that is equal only for equal values; floats keep their sign of zero."""
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(item) for item in value) + "]"
    return str(value)


def normal(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, build, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs first."""
    df = build(spark, sf_dir)
    left = normal(df.columns, [tuple(row) for row in df.collect()])
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    right = normal(names, result.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} / {len(right[1])}"
    for a, b in zip(left[1], right[1]):
        if a != b:
            return f"{a}\n{b}"
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    expected = {column[0]: str(column[1]).lower() for column in result.description}
    loose = {"int": "integer", "string": "varchar", "timestamp_ntz": "timestamp"}
    odd = {n: (k, expected[n]) for n, k in kinds.items() if loose.get(k, k) != expected[n]}
    return f"types {odd}" if odd else None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from gridspark.session import local_session

    spark = local_session("8")
    folder = sys.argv[1]
    wanted = sys.argv[2:]
    connection = connect(folder)
    sqls = oracle_sql()
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sqls:
                verdict = compare(spark, connection, build, sqls[name], folder)
            else:
                verdict = f"no SQL, {len(build(spark, folder).collect())} rows"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if verdict is None else 'DIFF'} {name} {time.time() - start:.1f}s {(verdict or '')[:1500]}", flush=True)
