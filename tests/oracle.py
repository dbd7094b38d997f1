"""Compare a registered query with its SQL on DuckDB.

Run as a script to check all queries, or those named on the command line:
``python tests/oracle.py [--sf 0.01] [--plain] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "smallint": "SMALLINT", "float": "FLOAT",
}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (2, "nan" if isinstance(value, float) and math.isnan(value) else repr(float(value)))
    return (3, str(value))


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    from tributary.plans.registry import ORACLES, QUERIES

    df = QUERIES[name](spark, sf_dir)
    ours_cols = sorted(df.columns)
    ours = [tuple(r) for r in df.select(*ours_cols).collect()]
    if name not in ORACLES:
        return None if ours else "no rows"
    result = con.execute(ORACLES[name])
    theirs_cols = [d[0] for d in result.description]
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    if sorted(theirs_cols) != ours_cols:
        return f"columns differ: {ours_cols} / {sorted(theirs_cols)}"
    for f in df.schema.fields:
        want = TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if want != theirs_types[f.name]:
            return f"type of {f.name}: {want} / {theirs_types[f.name]}"
    order = [theirs_cols.index(c) for c in ours_cols]
    theirs = [tuple(r[i] for i in order) for r in rows]
    if len(ours) != len(theirs):
        return f"rows differ: {len(ours)} / {len(theirs)}"
    a = sorted(ours, key=lambda r: [_key(v) for v in r])
    b = sorted(theirs, key=lambda r: [_key(v) for v in r])
    bad = [(x, y) for x, y in zip(a, b) if [_key(v) for v in x] != [_key(v) for v in y]]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {dict(zip(ours_cols, bad[0][0]))} / {dict(zip(ours_cols, bad[0][1]))}"
    if not a:
        return "no rows"
    return None


def main() -> int:
    from tributary.plans import queries  # noqa: F401
    from tributary.plans.registry import ORACLES, QUERIES
    from tributary.session import local_session

    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        i = args.index("--sf")
        sf = args[i + 1]
        del args[i : i + 2]
    sf_dir = f"/root/testdata/sf{sf}"
    if "--plain" in args:
        # A session with none of our settings and another time zone: results must not depend on either.
        from pyspark.sql import SparkSession

        args.remove("--plain")
        spark = (
            SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
            .config("spark.sql.session.timeZone", "America/New_York").getOrCreate()
        )
    else:
        spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in args or list(QUERIES):
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {time.time() - start:5.1f}s {'' if name in ORACLES else '(rows only) '}{name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    code = main()
    sys.stdout.flush()
    sys.exit(1 if code else 0)
