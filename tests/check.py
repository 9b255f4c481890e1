"""Compare every registered query with its SQL oracle.

    [CHECK_ZONE=Asia/Tokyo] python tests/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def oracle_frame(sql: str, folder: str) -> pd.DataFrame:
    with duckdb.connect() as connection:
        for name in TABLES:
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
        return connection.sql(sql).to_arrow_table().to_pandas()


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        return repr(v.item() if hasattr(v, "item") else v)

    ordered = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(value(v) for v in row) for row in ordered.itertuples(index=False))


def differences(found: pd.DataFrame, wanted: pd.DataFrame) -> str | None:
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    if len(found) != len(wanted):
        return f"rows {len(found)} != {len(wanted)}"
    kinds = {
        c: (found[c].dtype, wanted[c].dtype) for c in found.columns
        if found[c].dtype.kind != wanted[c].dtype.kind or found[c].dtype.itemsize != wanted[c].dtype.itemsize
    }
    if kinds:
        return f"types {kinds}"
    a, b = canonical(found), canonical(wanted)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    import __spark_entry__ as contract
    from creditmill.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    registered, oracles = contract.queries(), contract.oracle_sql()
    names = sys.argv[2:] or list(registered)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": os.environ.get("CHECK_ZONE", "UTC"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = registered[name](spark, folder).toPandas()
            took = time.time() - start
            problem = differences(found, oracle_frame(oracles[name], folder)) if name in oracles else None
        except Exception as error:  # noqa: BLE001 - report and go on
            took, problem, found = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}", []
        failed += problem is not None
        print(f"{'OK  ' if problem is None else 'FAIL'} {name:28s} {len(found):7d} rows {took:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main() and 1)
