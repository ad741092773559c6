"""Spark-vs-DuckDB comparison, the same shape as the driver's check.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        # Both sides already rounded to 6 dp: compare exactly (0.0 == -0.0).
        return (2, repr(v + 0.0))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return (3, str([_norm(x) for x in v]))
    return (4, str(v))


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str):
    import __spark_entry__ as E
    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        nan = [c for i, c in enumerate(scols) if any(isinstance(r[i], float) and not math.isfinite(r[i]) for r in srows)]
        return {"name": name, "rows": len(srows), "oracle": None, "nan": nan, "sec": round(t1 - t0, 2)}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    ok_rows = len(srows) == len(drows)
    ok_vals = ok_cols and canon(srows, scols) == canon(drows, dcols)
    out = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "cols": ok_cols,
           "values": ok_vals, "sec": round(t1 - t0, 2)}
    if not ok_cols:
        out["spark_cols"], out["duck_cols"] = scols, dcols
    elif not ok_vals:
        a, b = canon(srows, scols), canon(drows, dcols)
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        out["spark_only"], out["duck_only"] = diff_a, diff_b
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from parley.session import local_session
    import __spark_entry__ as E
    spark = local_session()
    con = duck(sf_dir)
    names = names or list(E.queries())
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "error": f"{e!r} {e}"[:600]}
        if r.get("error") or (r.get("oracle", True) is not None and not r.get("values", True)):
            bad += 1
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
