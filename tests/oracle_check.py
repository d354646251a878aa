"""Run registered queries in Spark and their oracle SQL in DuckDB; compare as multisets.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return v


def rows_of(table) -> tuple[list[str], list[tuple]]:
    cols = list(table.column_names)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    data = table.to_pylist()
    rows = [tuple(_norm(r[cols[i]]) for i in order) for r in data]
    rows.sort(key=repr)
    return [cols[i] for i in order], rows


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols, s_rows = rows_of(sdf.toArrow())
    t1 = time.time()
    o_cols, o_rows = rows_of(con.sql(sql).to_arrow_table())
    ok = s_cols == o_cols and s_rows == o_rows
    out = {"name": name, "ok": ok, "rows": len(s_rows), "oracle_rows": len(o_rows), "spark_sec": round(t1 - t0, 2)}
    if not ok:
        out["cols"] = (s_cols, o_cols) if s_cols != o_cols else None
        only_s = [r for r in s_rows if r not in set(o_rows)][:3]
        only_o = [r for r in o_rows if r not in set(s_rows)][:3]
        out["only_spark"] = only_s
        out["only_oracle"] = only_o
    return out


def main(argv):
    from edgeloom.session import build_session
    from __spark_entry__ import oracle_sql, queries
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in (names or qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": df.count()}, flush=True)
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": str(e)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
