"""Run catalogue queries next to their SQL: ``python tests/compare.py [sf_dir] [names...]``."""

import datetime as dt
import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    names, got = rows_of(df.columns, df.collect())
    expected_rows = con.sql(sql)
    expected_names, expected = rows_of(expected_rows.columns, expected_rows.fetchall())
    found = []
    if names != expected_names:
        found.append(f"columns {names} != {expected_names}")
    if got != expected:
        found.append(
            f"rows {got.total()} vs {expected.total()}; "
            f"only here {list((got - expected).items())[:3]}; "
            f"only in SQL {list((expected - got).items())[:3]}"
        )
    return found, got.total()


if __name__ == "__main__":
    from weirflow.catalog import ORACLE_SQL, QUERIES
    from weirflow.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = get_session(
        "compare", "local[8]", **{"spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            found, n = differences(session, con, sf_dir, QUERIES[name], ORACLE_SQL[name])
        except Exception as error:  # report and go on with the next query
            found, n = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        verdict = "DIFF" if found else "ok  "
        print(f"{verdict} {name} rows={n} {time.time() - start:.1f}s", *found, flush=True)
