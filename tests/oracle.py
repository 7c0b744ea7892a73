"""Run registered queries next to their SQL and compare: columns, row counts, values without order."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v) if not isinstance(v, bool) else repr(bool(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_rows, spark_cols, sql_rows, sql_cols) -> str | None:
    """None if equal, else the first difference."""
    if sorted(spark_cols) != sorted(sql_cols):
        return f"columns differ: {sorted(spark_cols)} / {sorted(sql_cols)}"
    if len(spark_rows) != len(sql_rows):
        return f"row counts differ: {len(spark_rows)} / {len(sql_rows)}"
    a, b = rows_of(spark_cols, spark_rows), rows_of(sql_cols, sql_rows)
    gone = [(x, y) for x, y in zip(a, b) if x != y]
    return None if not gone else f"{len(gone)} rows differ, first: {gone[0][0]} / {gone[0][1]}"


def main() -> None:
    import __spark_entry__ as entry
    from tabspark.session import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("check", "local[8]", 8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, sql = entry.queries(), entry.oracle_sql()
    wanted = [q for q in queries if not sys.argv[1:] or any(q == a or (a.endswith("*") and q.startswith(a[:-1])) for a in sys.argv[1:])]
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            df = queries[name](spark, sf)
            rows = [tuple(r) for r in df.collect()]
            if name in sql:
                got = con.execute(sql[name])
                cols = [d[0] for d in got.description]
                problem = compare(rows, df.columns, got.fetchall(), cols)
            else:
                problem = None if rows else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:40s} {time.time() - started:6.2f}s {'' if name in sql else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} ok; {sum(1 for q in wanted if q in sql)} with SQL")
    spark.stop()


if __name__ == "__main__":
    main()
