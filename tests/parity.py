"""Compare registered queries with their SQL: ``python tests/parity.py [data folder] [name ...]``."""

from __future__ import annotations

import glob
import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def _plain(value):
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    return repr(value)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_plain(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest()


def spark_result(df) -> tuple[list[str], list[tuple], list[str]]:
    kinds = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields]
    return df.columns, [tuple(r) for r in df.collect()], kinds


def duck_result(con, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    cursor = con.execute(sql)
    described = cursor.description
    return [d[0] for d in described], cursor.fetchall(), [f"{d[0]}:{d[1]}" for d in described]


def same_types(spark_kinds: list[str], duck_kinds: list[str]) -> bool:
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp"}

    def norm(kind: str) -> str:
        name, _, kind = kind.partition(":")
        return f"{name}:{names.get(kind, kind.lower().replace(' ', ''))}"

    return sorted(norm(k) for k in spark_kinds) == sorted(norm(k) for k in duck_kinds)


def main() -> int:
    import __spark_entry__ as entry
    from tradewind import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = session.build(master="local[8]", shuffle_partitions=8,
                          settings={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            columns, rows, kinds = spark_result(query(spark, sf_dir))
            spent = time.time() - start
            if name not in sqls:
                print(f"ROWS  {name:34s} {len(rows):8d} {spent:6.2f}s")
                continue
            duck_columns, duck_rows, duck_kinds = duck_result(con, sqls[name])
            equal = digest(columns, rows) == digest(duck_columns, duck_rows) and sorted(columns) == sorted(duck_columns)
            typed = same_types(kinds, duck_kinds)
            bad += not (equal and typed)
            print(f"{'ok   ' if equal else 'DIFF '} {'' if typed else 'TYPES'} {name:34s} {len(rows):8d} {spent:6.2f}s")
            if not equal:
                print("   spark", len(rows), sorted(map(str, rows))[:2], "\n   duck ", len(duck_rows), sorted(map(str, duck_rows))[:2])
            if not typed:
                print("   spark", sorted(kinds), "\n   duck ", sorted(duck_kinds))
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"ERROR {name}: {type(error).__name__}: {str(error)[:600]}")
    for name in sqls.keys() - entry.queries().keys():
        print("SQL without a query:", name)
        bad += 1
    return bad


if __name__ == "__main__":
    sys.exit(main())
