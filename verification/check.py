"""Run registered queries beside their SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # many queries in one session: keep their compiled stages
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # call sites of single column expressions, for error messages
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        # this session and its executors are one process
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="waterline-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(keyed, key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def spark_rows(df: DataFrame):
    return sorted(df.columns), _rows(df.columns, df.collect())


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def differences(got, expected) -> list[str]:
    (gc, gr), (ec, er) = got, expected
    if gc != ec:
        return [f"columns {gc} != {ec}"]
    if len(gr) != len(er):
        return [f"rows {len(gr)} != {len(er)}"]
    bad = [(g, e) for g, e in zip(gr, er, strict=True) if g != e]
    if not bad:
        return []
    first = {c: pair for c, pair in zip(gc, zip(*bad[0], strict=True), strict=True)}
    return [f"{len(bad)} rows differ, first: {first}"]


def main(argv: list[str]) -> int:
    from verification.registry import oracle_sql, queries

    sf_dir, names = argv[0], argv[1:]
    spark, con = local_session(), duck(sf_dir)
    all_queries, sql = queries(), oracle_sql()
    failed = 0
    for name in names or all_queries:
        started = time.time()
        try:
            got = spark_rows(all_queries[name](spark, sf_dir))
            took = time.time() - started
            if name in sql:
                found = differences(got, duck_rows(con, sql[name]))
            else:
                found = []
            note = "ok" if name in sql else "rows only"
            note = note if not found else "DIFF " + "; ".join(found)[:1500]
            failed += bool(found)
            print(f"{name:28s} {len(got[1]):8d} rows {took:6.2f}s  {note}", flush=True)
        except Exception as error:  # report and go on with the next query
            failed += 1
            print(f"{name:28s} ERROR {type(error).__name__}: {str(error)[:1200]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
