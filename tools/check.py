"""Run catalog queries on Spark and their SQL twins on DuckDB and compare the results.

    python tools/check.py [--sf 0.01] [name or prefix ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def session(cores: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("check").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def key(row):
    return tuple((str(type(x).__name__) if x is not None else "", repr(x)) for x in row)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import duckdb

    import catalog

    catalog.load()
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    spark = session()
    bad = []
    names = [n for n in catalog.QUERIES if not args.names or any(n.startswith(p) for p in args.names)]
    for name in names:
        t0 = time.time()
        try:
            df = catalog.QUERIES[name](spark, sf_dir)
            cols = sorted(df.columns)
            got = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
        except Exception as exc:
            bad.append(name)
            print(f"ERR   {name}: {str(exc)[:1500]}")
            if "--tb" in sys.argv:
                traceback.print_exc()
            continue
        t1 = time.time()
        sql = catalog.ORACLES.get(name)
        if sql is None:
            print(f"rows  {name}: {len(got)} rows {t1 - t0:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            names_d = [d[0] for d in cur.description]
            types_d = {d[0]: str(d[1]) for d in cur.description}
            rows = cur.fetchall()
        except Exception as exc:
            bad.append(name)
            print(f"SQLERR {name}: {str(exc)[:1500]}")
            continue
        t2 = time.time()
        if sorted(names_d) != cols:
            bad.append(name)
            print(f"COLS  {name}: {cols} vs {sorted(names_d)}")
            continue
        order = [names_d.index(c) for c in cols]
        want = [tuple(norm(r[i]) for i in order) for r in rows]
        odd = {c: t for c, t in types_d.items() if "HUGEINT" in t or "DECIMAL" in t or "[]" in t or "STRUCT" in t or "MAP" in t}
        spark_t = dict(df.dtypes)
        kinds = []
        for c in cols:
            s, d = spark_t[c], types_d[c].upper()
            ok = ((s == "string") == ("VARCHAR" in d or "STRING" in d)) and ((s == "double") == ("DOUBLE" in d)) and (
                (s == "bigint") == ("BIGINT" in d)) and ((s == "int") == ("INTEGER" in d)) and ((s == "boolean") == ("BOOL" in d))
            if not ok:
                kinds.append((c, s, types_d[c]))
        a, b = sorted(got, key=key), sorted(want, key=key)
        if a != b or odd or kinds:
            bad.append(name)
            print(f"DIFF  {name}: {len(got)} vs {len(want)} rows; types {odd} {kinds}")
            sa, sb = set(a), set(b)
            print("   cols ", cols)
            print("   spark", sorted(sa - sb, key=key)[:4])
            print("   sql  ", sorted(sb - sa, key=key)[:4])
        else:
            flag = "EMPTY " if not got else ""
            print(f"ok    {name}: {flag}{len(got)} rows spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s")
    print(f"{len(names) - len(bad)} of {len(names)} fine; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
