"""Compare a registered query with its SQL twin: columns, types, rows.

``python tests/oracle.py [sf_dir] [name…]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(cell(x) for x in v) + "]"
    return repr(v) if not hasattr(v, "isoformat") else v.isoformat()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, sf_dir)
    got_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    got_cols, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, map(str, rel.types)))
    want_cols, want = canonical(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got_types != want_types:
        return f"types { {k: (v, want_types[k]) for k, v in got_types.items() if v != want_types[k]} }"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    if not got:
        return "no rows to compare"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]} in {got_cols}" if bad else None


def main() -> int:
    import __spark_entry__ as contract
    from tabwarden.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session()
    con = connect(sf_dir)
    queries, oracles = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in args or queries:
        t = time.time()
        try:
            if name in oracles:
                why = compare(spark, con, queries[name], oracles[name], sf_dir)
                state = "equal" if why is None else f"FAIL {why}"
            else:
                why = None
                state = f"{len(queries[name](spark, sf_dir).collect())} rows, no SQL"
        except Exception as e:  # noqa: BLE001
            lines = [s for s in str(e).splitlines() if not s.lstrip().startswith("at ")]
            why = state = f"FAIL {type(e).__name__}: " + " | ".join(lines)[:1500]
        failed += why is not None
        print(f"{name:32s} {time.time() - t:6.2f}s {state}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
