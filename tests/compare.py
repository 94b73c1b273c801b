"""Compares a Spark result with the oracle's: same columns, types and rows, in any order."""

import math
from pathlib import Path

import duckdb

TABLES = [path.stem for path in Path("/root/testdata/sf0.001").glob("*.parquet")]


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def sort_key(row):
    return [(value is not None, str(type(value)), str(value)) for value in row]


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(row[i]) for i in order) for row in rows), key=sort_key)


SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def compare(df, connection, sql):
    """Differences as text, empty when there are none."""
    spark_names, spark_rows = normalised(df.columns, [tuple(row) for row in df.collect()])
    result = connection.execute(sql)
    names = [item[0] for item in result.description]
    types = {item[0]: str(item[1]) for item in result.description}
    names, rows = normalised(names, result.fetchall())
    problems = []
    if names != spark_names:
        return [f"columns {spark_names} != {names}"]
    for field in df.schema.fields:
        if SAME_TYPE.get(field.dataType.simpleString()) != types[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}")
    if len(rows) != len(spark_rows):
        problems.append(f"rows {len(spark_rows)} != {len(rows)}")
    differing = [(a, b) for a, b in zip(spark_rows, rows) if a != b]
    if differing:
        problems.append(f"{len(differing)} rows differ, first: {differing[0]}")
    return problems
