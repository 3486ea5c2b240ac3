"""Runs registered queries next to their SQL in DuckDB and compares the results."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# Spark type name to the DuckDB types it may be compared with.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP WITH TIME ZONE", "TIMESTAMP"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def sort_key(row):
    return tuple((value is not None, str(value)) for value in row)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result, empty when they agree."""
    relation = con.sql(sql)
    sql_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(sql_types) != sorted(spark_types):
        return [f"columns differ: spark {sorted(spark_types)} sql {sorted(sql_types)}"]
    problems = [
        f"type of {name}: spark {kind} sql {sql_types[name]}"
        for name, kind in spark_types.items()
        if sql_types[name] not in SAME_TYPE.get(kind, {kind})
    ]
    names = sorted(spark_types)
    ours = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=sort_key)
    order = [relation.columns.index(n) for n in names]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in relation.fetchall()), key=sort_key)
    if len(ours) != len(theirs):
        problems.append(f"row counts differ: spark {len(ours)} sql {len(theirs)}")
    if ours != theirs:
        only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
        problems.append(
            f"rows differ ({names}): spark only {len(only_ours)} {sorted(only_ours, key=sort_key)[:3]} "
            f"sql only {len(only_theirs)} {sorted(only_theirs, key=sort_key)[:3]}"
        )
    if not ours:
        problems.append("no rows at all")
    return problems
