"""Run registered queries and their SQL side by side: check_oracles.py SF_DIR [prefix ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wicketworks.catalog import ORACLES, QUERIES  # noqa: E402
from wicketworks.catalog.registry import NAMES  # noqa: E402
from wicketworks.session import create_session  # noqa: E402


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return repr(float(v))
        return str(v)

    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def connect(directory):
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def compare(spark, con, directory, name):
    """(rows, None when alike, else what differs)."""
    df = QUERIES[name](spark, directory)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    n = len(got[1])
    if name not in ORACLES:
        return n, None
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = canonical(columns, cursor.fetchall())
    if got[0] != want[0]:
        return n, f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return n, f"rows {n} / {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return n, f"{len(bad)} of {n} rows differ, e.g. {bad[0]}" if bad else None


def main():
    directory, prefixes = sys.argv[1], sys.argv[2:]
    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = create_session("check", settings, "local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    failed = 0
    for name in QUERIES:
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, directory, name)
        except Exception as error:  # noqa: BLE001
            n, problem = 0, f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        state = "FAIL " + problem if problem else ("ok" if name in ORACLES else "ok (rows only)")
        print(f"{name:45s} {time.time() - start:6.2f}s {n:8d} rows {state}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
