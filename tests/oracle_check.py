"""Run queries against their SQL in DuckDB: python tests/oracle_check.py [sf] [name part ...]"""

from __future__ import annotations

import logging
import sys
import tempfile
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def canon(v):
    if isinstance(v, float):
        return ("f", "nan") if v != v else ("f", f"{round(v, 6) + 0.0:.6f}")
    if isinstance(v, Decimal):
        return ("d", str(v.normalize()))
    if isinstance(v, (list, tuple)):
        return ("l", tuple(canon(x) for x in v))
    if isinstance(v, dict):
        return ("m", tuple(sorted((str(k), canon(x)) for k, x in v.items())))
    if isinstance(v, (datetime, date)):
        return ("t", str(v))
    return (type(v).__name__, str(v))


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = sorted((tuple(canon(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if got == want:
        return None
    swant, sgot = set(want), set(got)
    extra = [r for r in got if r not in swant][:2] if len(got) < 200000 else []
    miss = [r for r in want if r not in sgot][:2] if len(got) < 200000 else []
    return f"rows {len(got)} != {len(want)}\n   spark only {extra}\n   duckdb only {miss}"


def session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(argv: list[str]) -> int:
    logging.disable(logging.CRITICAL)
    sf = argv[0] if argv else "0.01"
    parts = argv[1:]
    import __spark_entry__ as e

    folder = f"/root/testdata/sf{sf}"
    spark, con, sqls, bad = session(), duck(folder), e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        t = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                diff = compare(df, con, sqls[name])
                note = "ok" if diff is None else "DIFF " + diff
            else:
                diff, n = None, len(df.collect())
                note = f"rows {n}"
        except Exception as err:  # report and go on with the next query
            diff = note = f"ERROR {type(err).__name__}: {str(err)[:900]}"
        bad += diff is not None
        print(f"{name:38s} {time.time() - t:6.2f}s {note}", flush=True)
    print(f"failed: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
