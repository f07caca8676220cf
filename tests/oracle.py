"""Compare a registered query with its SQL on DuckDB; also runs from the command line."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree on columns, types of values and the multiset of rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wanted = _rows(names, result.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if not got:
        return "no rows"
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return (
            f"{sum(got.values())} rows vs {sum(wanted.values())}; "
            f"spark only {sum(extra.values())}: {list(extra)[:2]}; "
            f"sql only {sum(missing.values())}: {list(missing)[:2]}"
        )
    kinds_got = [{type(v).__name__ for v in c} - {"NoneType"} for c in zip(*got, strict=True)]
    kinds_sql = [{type(v).__name__ for v in c} - {"NoneType"} for c in zip(*wanted, strict=True)]
    bad = [
        (n, a, b)
        for n, a, b in zip(sorted(names), kinds_got, kinds_sql, strict=True)
        if a and b and a != b
    ]
    return f"value types {bad}" if bad else None


def main(argv: list[str]) -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from tests.conftest import local_session

    sf_dir = f"/root/testdata/{argv[0]}"
    wanted = argv[1:]
    spark, con = local_session(), connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                problem = differences(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        status = "ok" if problem is None else f"FAIL {problem}"
        note = "" if name in oracles else " (rows only)"
        print(f"{name:28} {time.time() - start:6.2f}s {status}{note}", flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
