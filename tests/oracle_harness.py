"""Run registered queries in Spark and their SQL in DuckDB; compare.

Mirrors the correctness gate: columns sorted by name, rows compared as a
multiset; floats compared after rounding to 9 significant digits, or bit
for bit with ``--exact``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False  # True: compare floats bit for bit (set by --exact)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == 0:
            return 0.0
        if math.isinf(v) or EXACT:
            return v
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return _norm(float(v))
    except Exception:
        pass
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    rows = df.select(*cols).collect()
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in rows)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, con=None, verbose=True):
    from tabletrust.plans import REGISTRY

    q = REGISTRY[name]
    t0 = time.time()
    scols, srows = spark_rows(q.build(spark, sf_dir))
    ts = time.time() - t0
    if not q.sql:
        return {"name": name, "rows": sum(srows.values()), "oracle": None, "sec": ts}
    con = con or duck(sf_dir)
    dcols, drows = duck_rows(con, q.sql)
    ok = scols == dcols and srows == drows
    res = {"name": name, "rows": sum(srows.values()), "oracle_rows": sum(drows.values()), "ok": ok, "sec": ts}
    if not ok and verbose:
        res["cols"] = (scols, dcols)
        res["only_spark"] = list((srows - drows).items())[:3]
        res["only_duck"] = list((drows - srows).items())[:3]
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import tempfile

    from tabletrust.session import build_session, ensure_checkpoint_dir

    args = [a for a in sys.argv[1:] if a != "--exact"]
    EXACT = "--exact" in sys.argv
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tt-ckpt-", dir="/tmp"))
    from tabletrust.plans import REGISTRY

    con = duck(sf)
    bad = 0
    for n in names or list(REGISTRY):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:600]}
        if r.get("ok") is False or "error" in r:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)
