"""Run registered queries in Spark and their oracle SQL in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
          "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(sdf, rel):
    """Columns whose Spark type and DuckDB type differ (by name)."""
    st = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for c, t in st.items():
        want = _TYPES.get(t, t.upper())
        if c in dt and dt[c] != want:
            out.append(f"{c}: spark {t} / duck {dt[c]}")
    return out


def duck(sf_dir):
    from featlab.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from featlab.session import local_session
    spark = local_session(8, 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            rel = con.sql(sqls[name])
            drows, dcols = rel.fetchall(), rel.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        a, b = canon(srows, scols), canon(drows, dcols)
        tm = type_mismatches(sdf, rel)
        if a == b and tm:
            print(f"TYPE {name}: values equal, types differ: {tm}")
            bad += 1
        elif a == b:
            print(f"OK   {name}: {len(a)} rows ({ts:.1f}s)")
        else:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: rows spark={len(a)} duck={len(b)} first diffs={diff}")
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
