"""Value comparison of a Spark result with the oracle engine's result."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def sorted_rows(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


_SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def type_differences(df, con, sql: str) -> dict[str, tuple[str, str]]:
    spark_types = {name: _SAME_TYPE.get(t, t) for name, t in df.dtypes}
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return {
        row[0]: (spark_types.get(row[0], "-"), row[1])
        for row in described
        if spark_types.get(row[0]) != row[1]
    }


def differences(df, con, sql: str, show: int = 5) -> str | None:
    """A description of how the results differ, or None."""
    (cols, rows), (ocols, orows) = spark_rows(df), oracle_rows(con, sql)
    if cols != ocols:
        return f"columns {cols} != {ocols}"
    types = type_differences(df, con, sql)
    if types:
        return f"types differ (spark, oracle): {types}"
    if rows == orows:
        return None
    ours, theirs = set(map(repr, rows)), set(map(repr, orows))
    return (
        f"{len(rows)} rows, oracle {len(orows)}\n  only spark: {sorted(ours - theirs)[:show]}"
        f"\n  only oracle: {sorted(theirs - ours)[:show]}"
    )
