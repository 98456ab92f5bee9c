"""Compare queries with their SQL twins: ``python -m workload.check [sf] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _ordered(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple(map(_rank, r)))


def _rank(v):
    if v is None:
        return (0, "")
    if isinstance(v, (bool, int, float)):
        return (1, round(float(v), 4))
    return (2, str(v))


def _same(a, b, tolerance: float) -> bool:
    if isinstance(a, float) and isinstance(b, (int, float)):
        return a == b or (tolerance > 0 and math.isclose(a, b, rel_tol=tolerance, abs_tol=tolerance))
    return a == b


def compare(df, con, sql: str) -> str:
    """``exact``, ``close`` (within 1e-6) or what differs."""
    columns, rows = _ordered(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = _ordered(names, cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for tolerance, verdict in ((0.0, "exact"), (1e-6, "close")):
        wrong = next(
            (
                (r, e)
                for r, e in zip(rows, expected, strict=True)
                if not all(_same(x, y, tolerance) for x, y in zip(r, e, strict=True))
            ),
            None,
        )
        if wrong is None:
            return f"{verdict} ({len(rows)} rows)"
    cells = [
        (c, x, y) for c, x, y in zip(columns, *wrong, strict=True) if not _same(x, y, 1e-6)
    ]
    return f"values differ: {cells[:4]}"


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("zephyrine")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(arguments: list[str]) -> int:
    from workload.catalogue import ORACLES, QUERIES

    sf = arguments[0] if arguments else "0.01"
    wanted = arguments[1:] or list(QUERIES)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            verdict = (
                compare(df, con, ORACLES[name])
                if name in ORACLES
                else f"no twin ({df.count()} rows)"
            )
        except Exception as error:  # report and go on with the other queries
            verdict = "ERROR " + str(error).strip().split("\n")[0][:300]
            if len(wanted) < 4:
                traceback.print_exc()
        fine = verdict.startswith(("exact", "close", "no twin"))
        bad += not fine
        print(f"{'ok ' if fine else 'BAD'} {name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
