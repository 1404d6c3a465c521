"""Run registered queries on Spark and DuckDB and compare whole results.

    python -m tests.oracle_check [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import numpy as np

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, (float, np.floating)):
        return None if math.isnan(value) else round(float(value), 6)
    if isinstance(value, np.generic):
        return value.item()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def difference(spark, db, name: str, sf_dir: str) -> str | None:
    """None if both engines agree, else a short description."""
    result = queries()[name](spark, sf_dir)
    got = _rows(result.columns, result.collect())
    if name not in oracle_sql():
        return None
    cursor = db.execute(oracle_sql()[name])
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if got[1] == want[1]:
        kinds = [{type(v) for v in column if v is not None} for column in zip(*got[1])]
        expected = [{type(v) for v in column if v is not None} for column in zip(*want[1])]
        return None if kinds == expected else f"types {kinds} vs {expected}"
    only_got = sorted(set(got[1]) - set(want[1]), key=repr)[:2]
    only_want = sorted(set(want[1]) - set(got[1]), key=repr)[:2]
    return f"rows {len(got[1])} vs {len(want[1])}\n  spark  {str(only_got)[:700]}\n  duckdb {str(only_want)[:700]}"


def main() -> None:
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, db = make_session(), connect(sf_dir)
    for name in sys.argv[2:] or queries():
        start = time.time()
        try:
            found = difference(spark, db, name, sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "oracle" if name in oracle_sql() else "rows"
        print(f"{'ok  ' if found is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
