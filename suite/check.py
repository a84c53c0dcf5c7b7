"""Runs registered queries on both engines and compares rows: python -m suite.check <sf_dir> [name ...]."""

from __future__ import annotations

import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    text = [c for c in pdf.columns if pdf[c].dtype == object or str(pdf[c].dtype) in ("bool", "boolean", "str")]
    for c in pdf.columns:
        if c not in text:
            pdf = pdf.assign(**{c: pdf[c].astype("float64")})
    first = text + [c for c in pdf.columns if c not in text]
    return pdf.sort_values(first, kind="mergesort").reset_index(drop=True)


def differences(a: pd.DataFrame, b: pd.DataFrame) -> str:
    """Empty when equal."""
    if sorted(a.columns) != sorted(b.columns):
        return f"columns {sorted(set(a.columns) ^ set(b.columns))[:8]}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    a, b = ordered(a), ordered(b)
    bad = []
    for c in a.columns:
        x, y = a[c], b[c]
        same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            at = int(np.argmax(~same.to_numpy()))
            bad.append(f"{c}: {int((~same).sum())} rows, e.g. {x.iloc[at]!r} != {y.iloc[at]!r}")
    return "; ".join(bad[:6])


def main() -> None:
    from pulsegrid.session import local_session
    from suite.queries import ORACLES, QUERIES

    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    failed = []
    for name in names:
        t0 = time.time()
        try:
            got = QUERIES[name](spark, sf).toPandas()
            t1 = time.time()
            want = con.execute(ORACLES[name]).df()
            diff = differences(got, want)
        except Exception as e:  # a broken query must not hide the others
            t1, got, diff = time.time(), [], f"{type(e).__name__}: {str(e)[:700]}"
        if diff:
            failed.append(name)
        print(f"{'ok  ' if not diff else 'FAIL'} {name} rows={len(got)} spark={t1 - t0:.2f}s duck={time.time() - t1:.2f}s {diff}",
              flush=True)
    print(f"{len(names) - len(failed)} of {len(names)} equal; failed: {failed}")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
