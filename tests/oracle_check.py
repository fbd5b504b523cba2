"""Compare registered Spark queries with their DuckDB oracle (a local stand-in for
the driver's correctness gate): row count, column names + types, and an
order-insensitive hash of normalised values."""
from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def digest(rows, order):
    keyed = sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
    return hashlib.sha256(repr(keyed).encode()).hexdigest()[:16], keyed


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    st = time.time() - t0
    scols = sdf.columns
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows), "sec": round(st, 2)}
    if sorted(scols) != sorted(dcols):
        res["ok"] = False
        res["why"] = f"columns {sorted(scols)} vs {sorted(dcols)}"
        return res
    so = [scols.index(c) for c in sorted(scols)]
    do = [dcols.index(c) for c in sorted(dcols)]
    hs, ks = digest(srows, so)
    hd, kd = digest(drows, do)
    res["ok"] = (hs == hd)
    if not res["ok"]:
        diff_s = [k for k in ks if k not in set(kd)][:3]
        diff_d = [k for k in kd if k not in set(ks)][:3]
        res["why"] = f"spark-only {diff_s} oracle-only {diff_d}"
    return res


def _pandas_cells(pdf, cols):
    import pandas as pd
    out = []
    for row in pdf[cols].itertuples(index=False):
        cells = []
        for v in row:
            if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
                cells.append(None)
            elif isinstance(v, float):
                cells.append(f"{v:.9g}")
            elif hasattr(v, "item") and not isinstance(v, (str, bytes)):
                x = v.item()
                cells.append(f"{x:.9g}" if isinstance(x, float) else str(pd.Timestamp(v)) if "datetime" in str(type(v)) else str(x))
            else:
                cells.append(str(pd.Timestamp(v)) if isinstance(v, (dt.date, dt.datetime)) else str(v))
        out.append(tuple(cells))
    return sorted(out, key=repr)


def compare_pandas(spark, name, fn, sql, sf_dir, con):
    """Like ``compare`` but through pandas on both sides (toPandas / DuckDB df())."""
    sdf = fn(spark, sf_dir).toPandas()
    ddf = con.execute(sql).df()
    cols = sorted(sdf.columns)
    if cols != sorted(ddf.columns):
        return {"name": name, "ok": False, "why": "columns"}
    a, b = _pandas_cells(sdf, cols), _pandas_cells(ddf, cols)
    res = {"name": name, "ok": a == b, "rows": (len(a), len(b))}
    if not res["ok"]:
        res["why"] = f"{[x for x in a if x not in set(b)][:2]} vs {[x for x in b if x not in set(a)][:2]}"
    return res


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from layerkit.session import build_session
    spark = build_session("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            sdf = qs[name](spark, sf_dir)
            print({"name": name, "rows_only": sdf.count()})
            continue
        try:
            r = (compare_pandas if PANDAS else compare)(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "ok": False, "why": repr(e)[:400]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED", bad)
    return bad


PANDAS = False

if __name__ == "__main__":
    args = sys.argv[1:]
    if "--pandas" in args:
        PANDAS = True
        args.remove("--pandas")
    main(args or None)
