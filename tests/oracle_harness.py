"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]

Compares column names, row counts and the multiset of rows (floats rounded,
timestamps as text) between ``queries()[name]`` and ``oracle_sql()[name]``.
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "isoformat"):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
}


def _type_mismatches(sdf, cur) -> list:
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    bad = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        got = duck_types.get(f.name)
        if got is not None and got != want:
            bad.append((f.name, f.dataType.simpleString(), got))
    return bad


def compare(spark, sf_dir: str, name: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
        return res
    types = _type_mismatches(sdf, cur)
    if types:
        res["status"] = f"TYPES {types}"
        return res
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if a == b:
        res["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "MISMATCH"
        res["only_spark"] = [x for x in a if x not in sb][:3]
        res["only_duck"] = [x for x in b if x not in sa][:3]
    return res


def main(argv):
    from moodwatch.session import local_session
    from __spark_entry__ import queries
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
