"""Compare registered queries with their SQL: python tests/oracle_check.py sf_dir [name...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def rows_of(names: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, connection, sf: str, name: str, function, sql: str | None) -> tuple[str, float, float]:
    began = time.time()
    result = function(spark, sf)
    mine = rows_of(result.columns, [tuple(row) for row in result.collect()])
    spark_time = time.time() - began
    if sql is None:
        return f"no sql, {len(mine)} rows", spark_time, 0.0
    began = time.time()
    cursor = connection.execute(sql)
    theirs = rows_of([column[0] for column in cursor.description], cursor.fetchall())
    sql_time = time.time() - began
    if mine == theirs:
        return f"ok {len(mine)} rows", spark_time, sql_time
    extra = [row for row in mine if row not in set(theirs)][:3]
    lost = [row for row in theirs if row not in set(mine)][:3]
    return (
        f"DIFFERS spark {len(mine)} rows, sql {len(theirs)} rows\n   only spark {str(extra)[:600]}\n   only sql {str(lost)[:600]}",
        spark_time,
        sql_time,
    )


def connect(sf: str):
    import duckdb

    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def main() -> None:
    from tokenloom.session import local_session

    import __spark_entry__ as entry

    sf, chosen = sys.argv[1], sys.argv[2:]
    spark, connection = local_session(8), connect(sf)
    sql = entry.oracle_sql()
    for name, function in entry.queries().items():
        if chosen and name not in chosen:
            continue
        try:
            text, spark_time, sql_time = compare(spark, connection, sf, name, function, sql.get(name))
        except Exception as error:  # the report goes on with the next query
            text, spark_time, sql_time = f"FAILED {type(error).__name__} {str(error)[:700]}", 0, 0
        print(f"{name}: {text} [{spark_time:.1f}s, {sql_time:.1f}s]", flush=True)


if __name__ == "__main__":
    main()
