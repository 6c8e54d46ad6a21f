"""Run registered queries on Spark and their SQL twins on DuckDB and compare the results.

usage: python check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb

from obsledger import queries as Q
from obsledger.session import get_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def rows_of(arrow):
    names = sorted(arrow.column_names)
    cols = [arrow.column(n).to_pylist() for n in names]
    return names, sorted(tuple(map(norm, r)) for r in zip(*cols))


def compare(spark_arrow, sql_arrow) -> str:
    sn, sr = rows_of(spark_arrow)
    qn, qr = rows_of(sql_arrow)
    if sn != qn:
        return f"columns differ: {sn} / {qn}"
    types = [(n, str(spark_arrow.schema.field(n).type), str(sql_arrow.schema.field(n).type)) for n in sn]
    odd = [t for t in types if t[1] != t[2] and {t[1], t[2]} != {"string", "large_string"}]
    if len(sr) != len(qr):
        return f"row counts differ: {len(sr)} / {len(qr)}"
    for a, b in zip(sr, qr):
        if a != b:
            return f"values differ: {a} / {b}"
    return f"types differ: {odd}" if odd else "ok"


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g",
                                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    Q.load_all()
    con, bad = connect(args.sf), 0
    for name in args.names or list(Q.QUERIES):
        start = time.perf_counter()
        try:
            got = Q.QUERIES[name](spark, args.sf).toArrow()
            took = time.perf_counter() - start
            if name in Q.ORACLES:
                verdict = compare(got, con.execute(Q.ORACLES[name]).to_arrow_table())
            else:
                verdict = f"rows only: {got.num_rows}"
        except Exception as e:  # report and go on to the next query
            took, verdict = time.perf_counter() - start, f"failed: {str(e)[:600]}"
        good = verdict == "ok" or verdict.startswith("rows only")
        bad += not good
        print(f"{'' if good else '!! '}{name}: {verdict} ({took:.2f}s)", flush=True)
    print(f"{bad} bad of {len(args.names or Q.QUERIES)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
