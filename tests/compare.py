"""Run registered queries against DuckDB on the same parquet files.

python tests/compare.py <sf_dir> [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0 if v != 0 else 0.0)
    if isinstance(v, (list, tuple)):
        return tuple(plain(i) for i in v)
    if isinstance(v, dict):
        return tuple(plain(i) for i in v.values())
    return v if v is None or isinstance(v, (bool, int, str)) else str(v)


def kind(t: str) -> str:
    t = str(t).lower()
    for names, k in ((("bigint", "int64"), "bigint"), (("integer", "int32", "int"), "int"),
                     (("double", "float64"), "double"), (("varchar", "string"), "string"),
                     (("boolean", "bool"), "boolean")):
        if t in names:
            return k
    return t


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def check(name, spark, con, sf_dir, queries, oracles):
    t0 = time.time()
    df = queries[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    result = {"name": name, "rows": len(rows), "sec": round(t1 - t0, 2), "ok": True, "why": ""}
    if not rows:
        result.update(ok=False, why="no rows")
    if name not in oracles:
        result["why"] = "rows only"
        return result
    cur = con.execute(oracles[name])
    cols = [d[0] for d in cur.description]
    types = {d[0]: kind(d[1]) for d in cur.description}
    expected = cur.fetchall()
    result["oracle_sec"] = round(time.time() - t1, 2)
    if sorted(cols) != sorted(df.columns):
        result.update(ok=False, why=f"columns {sorted(df.columns)} != {sorted(cols)}")
        return result
    ours = {c: kind(t) for c, t in df.dtypes}
    diff = {c: (ours[c], types[c]) for c in cols if ours[c] != types[c]}
    a, b = canonical(df.columns, rows), canonical(cols, expected)
    if len(a) != len(b):
        result.update(ok=False, why=f"rows {len(a)} != {len(b)}")
    elif a != b:
        ours_only, theirs = Counter(a) - Counter(b), Counter(b) - Counter(a)
        result.update(ok=False, why=f"{sum(ours_only.values())} of {len(a)} rows differ, {sorted(cols)} "
                      f"{sorted(ours_only, key=repr)[:3]} != {sorted(theirs, key=repr)[:3]}")
    elif diff:
        simple = {c: v for c, v in diff.items() if "[" not in v[1] and "struct" not in v[1]}
        if simple:
            result.update(ok=False, why=f"types {simple}")
    return result


if __name__ == "__main__":
    import __spark_entry__ as entry
    from specspark.session import local_session

    sf = sys.argv[1]
    spark = local_session("8")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    bad = 0
    for n in names:
        try:
            r = check(n, spark, con, sf, queries, oracles)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:1500]}"}
        bad += not r["ok"]
        print("ok " if r["ok"] else "BAD", {k: v for k, v in r.items() if k != "ok"}, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
