"""Runs registered queries next to their SQL and compares the rows.

    python tests/oracle.py [scale folder] [name or prefix ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "\x00"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return repr(round(x, 9))
    return str(x)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, run, sql):
    """None when equal, else a description of the difference."""
    df = run(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)} rows; e.g. {[r for r in mine if r not in theirs][:2]} / {[r for r in theirs if r not in mine][:2]}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, e.g.\n   spark {wrong[0][0]}\n   sql   {wrong[0][1]}"
    return None


def main(argv):
    from tallyrow import catalog
    from tallyrow.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    queries, oracles = catalog.queries(), catalog.oracle_sql()
    failed = []
    for name, run in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, run, oracles[name])
            else:
                n = run(spark, sf_dir).count()
                problem = None if n else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name}", flush=True)
        if problem:
            print("   ", problem[:2500], flush=True)
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
