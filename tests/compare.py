"""Run registered queries and their oracle SQL side by side: python tests/compare.py [sf dir] [name part ...]"""

from __future__ import annotations

from collections import Counter
from pathlib import Path
import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

SAME_TYPE = {"int": "INTEGER", "string": "VARCHAR"}


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns):
    """Rows as a multiset of value tuples in column-name order, types included."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float) and math.isnan(v):
            return ("nan",)
        return (type(v).__name__, v)

    return Counter(tuple(value(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir, build, sql) -> str:
    """Empty text when both sides agree, else what differs."""
    df = build(spark, sf_dir)
    columns = df.columns
    ours = canonical([tuple(r) for r in df.collect()], columns)
    if sql is None:
        return "" if sum(ours.values()) > 0 else "no rows"
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(theirs_columns):
        return f"columns {sorted(columns)} != {sorted(theirs_columns)}"
    spark_types = {name: SAME_TYPE.get(kind, kind.upper()) for name, kind in df.dtypes}
    oracle_types = {d[0]: str(d[1]) for d in result.description}
    if spark_types != oracle_types:
        return f"types {sorted(set(spark_types.items()) ^ set(oracle_types.items()))}"
    theirs = canonical(result.fetchall(), theirs_columns)
    if not ours:
        return "no rows"
    if ours != theirs:
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}\n    only ours   {list((ours - theirs).items())[:2]}"
            f"\n    only oracle {list((theirs - ours).items())[:2]}"
        )
    return ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from claimspan.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    session = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = oracle(sf)
    sqls = oracle_sql()
    bad = []
    for query, build_query in queries().items():
        if wanted and not any(w in query for w in wanted):
            continue
        started = time.time()
        try:
            problem = compare(session, connection, sf, build_query, sqls.get(query))
        except Exception as error:  # noqa: BLE001
            problem = "".join(traceback.format_exception_only(error))[:1500]
        print(f"{'FAIL' if problem else 'ok  '} {query} {time.time() - started:.2f}s {problem}", flush=True)
        if problem:
            bad.append(query)
    print(f"{len(bad)} failed: {bad}")
