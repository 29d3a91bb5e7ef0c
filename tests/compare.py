"""Run registered queries and their SQL on the same tables and compare all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


# How the types of both engines answer to each other.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
}


def spark_types(df) -> dict[str, str]:
    return {name: TYPES[kind] for name, kind in df.dtypes}


def oracle_types(connection, sql: str) -> dict[str, str]:
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, _sorted(tuple(row[name] for name in names) for row in df.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    names = sorted(columns)
    positions = [columns.index(name) for name in names]
    return names, _sorted(tuple(row[p] for p in positions) for row in cursor.fetchall())


def _sorted(rows) -> list[tuple]:
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])
