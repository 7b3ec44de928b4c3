"""Run queries next to their SQL on the same tables and compare the rows.

    python -m contract.compare <folder of test tables> [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def open_duckdb(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.12g}")
    return value


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


_SAME = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(spark, con, sf_dir: str, run, sql: str) -> str:
    """Empty when rows, names and types agree, else what differs."""
    df = run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = rows_of(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    odd = [(c, t, types[c]) for c, t in df.dtypes if _SAME.get(t, t) != types[c]]
    if odd:
        return f"types {odd}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows {sum(got.values())} / {sum(want.values())}\n  only spark {extra}\n  only sql   {missing}"
    return ""


def main() -> None:
    from contract.oracle import all_statements
    from contract.queries import all_queries
    from silvertide.session import local_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(cores="8"), open_duckdb(sf_dir)
    statements, bad = all_statements(), []
    for name, run in all_queries().items():
        if name not in statements or (wanted and name not in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, run, statements[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.1f}s {problem}"[:1600], flush=True)
        if problem:
            bad.append(name)
    print("failed:", bad)


if __name__ == "__main__":
    main()
