"""Run registered queries and their SQL on the same tables and compare all values.

``python tests/oracle_check.py [sf_dir] [name part ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402


def connect(sf_dir: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    """Rows as text, columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df) -> tuple[list[str], list[tuple[str, ...]]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(db, sql: str) -> tuple[list[str], list[tuple[str, ...]]]:
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def main() -> int:
    import __spark_entry__ as entry
    from marketstream.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__log__level="ERROR", spark__ui__showConsoleProgress="false",
                          spark__checkpoint__dir=tempfile.mkdtemp(prefix="oracle-"))
    db, sqls, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        begin = time.time()
        try:
            df = query(spark, sf_dir)
            got_columns, got = spark_rows(df)
            took = time.time() - begin
            if name not in sqls:
                print(f"rows  {name:32} {len(got):7} {took:6.2f}s")
                continue
            columns, expected = sql_rows(db, sqls[name])
            types = {c: t for c, t in df.dtypes}
        except Exception as e:  # report and go on with the next query
            bad += 1
            print(f"FAIL  {name:32} {type(e).__name__}: {str(e)[:1500]}")
            continue
        ok = columns == got_columns and expected == got
        bad += not ok
        print(f"{'ok' if ok else 'DIFF':5} {name:32} {len(got):7} {took:6.2f}s")
        if not ok:
            print("   columns", got_columns, columns, types)
            print("   rows", len(got), len(expected))
            a, b = set(got) - set(expected), set(expected) - set(got)
            for label, extra in (("spark only", a), ("sql only", b)):
                for row in sorted(extra)[:3]:
                    print("  ", label, row)
    missing = set(sqls) - set(entry.queries())
    if missing:
        print("SQL without a query:", sorted(missing))
    print("bad:", bad)
    return 1 if bad or missing else 0


if __name__ == "__main__":
    raise SystemExit(main())
