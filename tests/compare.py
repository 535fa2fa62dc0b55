"""Compare every query with its SQL: python tests/compare.py [folder] [query ...]"""

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
)


def connect(folder):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES.split():
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[k] for k in order], Counter(tuple(_plain(row[k]) for k in order) for row in rows)


def difference(con, df, sql):
    """None when equal, else what differs."""
    names, got = _rows(df.columns, [tuple(row) for row in df.collect()])
    cursor = con.execute(sql)
    expected_names, expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if names != expected_names:
        return f"columns {names} <> {expected_names}"
    if got != expected:
        extra, missing = got - expected, expected - got
        return (
            f"{sum(got.values())} rows, {sum(expected.values())} expected; "
            f"only in Spark {list(extra)[:3]}; only in SQL {list(missing)[:3]}"
        )
    return None


def main():
    import __spark_entry__ as entry
    from filingmill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare",
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            wrong = difference(con, df, sql[name]) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on to the next query
            wrong = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += wrong is not None
        mark = "ok " if wrong is None else "BAD"
        print(f"{mark} {time.time() - start:6.2f}s {name} {wrong or ''}", flush=True)
    print(f"{bad} differ; SQL without query: {sorted(set(sql) - set(entry.queries()))}")
    spark.stop()


if __name__ == "__main__":
    main()
