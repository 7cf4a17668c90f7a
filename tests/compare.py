"""Compare registered queries with their SQL counterparts: ``python -m tests.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _key(row):
    return tuple((v is not None, type(v).__name__ == "str", str(v)) for v in row)


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


def differences(df, con, sql: str) -> str | None:
    """None when names, types and values agree, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    wrong = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields
             if _KINDS.get(kinds[f.name], kinds[f.name]) != f.dataType.simpleString()]
    order = sorted(names)
    ours = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    theirs = [tuple(_plain(r[names.index(c)]) for c in order) for r in theirs]
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(sorted(ours, key=_key), sorted(theirs, key=_key)) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ on {order}, e.g. {bad[0][0]} != {bad[0][1]}"
    return f"types {wrong}" if wrong else None


def main(argv):
    from lotmill.session import get_session
    from lotmill.workload import ORACLES, QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = get_session("compare", f"local[{os.environ.get('BENCH_CPUS', '8')}]", spark__sql__shuffle__partitions="8",
                        spark__driver__memory="8g", spark__ui__enabled="false", spark__log__level="ERROR")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name, fn in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in ORACLES:
                problem = differences(df, con, ORACLES[name])
            else:
                problem = None if df.count() >= 0 else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None
        tag = "ok  " if problem is None else "FAIL"
        print(f"{tag} {name:34s} {time.time() - start:6.2f}s {'' if name in ORACLES else '(rows only) '}{problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
