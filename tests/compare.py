"""Run each query and its SQL side by side and compare all rows."""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    return (1, repr(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{sorted(names)} rows {len(a)}/{len(b)}\n  spark {only_a}\n  sql   {only_b}"


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from twinflow.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con, bad = connection(sf_dir), 0
    queries, sql = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(sql)), "unknown:", sorted(set(sql) - set(queries)))
    for name in names or queries:
        t = time.time()
        try:
            diff = difference(queries[name](spark, sf_dir), con, sql[name])
        except Exception as e:
            diff = f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - t:.1f}s {diff or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
