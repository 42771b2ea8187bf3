"""Runs registered queries against their SQL: ``python tests/compare.py SF_DIR [query ...]``."""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def open_oracle(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def difference(found: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else a short description."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    if len(found) != len(wanted):
        return f"{len(found)} rows != {len(wanted)}"
    found, wanted = normal(found), normal(wanted)
    kinds = [
        f"{c}: {found[c].dtype} != {wanted[c].dtype}"
        for c in found.columns
        if found[c].dtype.kind != wanted[c].dtype.kind
        or found[c].dtype.itemsize != wanted[c].dtype.itemsize
    ]
    if kinds:
        return "types " + ", ".join(kinds)
    for c in found.columns:
        same = (found[c] == wanted[c]) | (found[c].isna() & wanted[c].isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{c}: {(~same).sum()} values differ, {found[c][at]!r} != {wanted[c][at]!r}"
    return None


def main():
    import __spark_entry__ as entry
    from bench import session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = session("compare")
    con = open_oracle(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = query(spark, sf_dir).toPandas()
            took = time.time() - start
            if name not in oracle:
                print(f"rows  {name} {len(found)} rows {took:.1f}s", flush=True)
                continue
            gap = difference(found, con.sql(oracle[name]).df())
        except Exception as failure:
            gap, took, found = f"{type(failure).__name__} {str(failure)[:1500]}", 0, []
        bad += gap is not None
        print(f"{'FAIL ' + gap if gap else 'ok   '} {name} {len(found)} rows {took:.1f}s", flush=True)
    print(f"{bad} differences")


if __name__ == "__main__":
    main()
