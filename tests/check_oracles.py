"""Run registered queries and their SQL side by side: ``check_oracles.py [sf_dir] [name ...]``."""

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """Empty string if equal, else what differs."""
    df = query(spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if ours != theirs:
        left = [r for r in ours if r not in set(theirs)][:3]
        right = [r for r in theirs if r not in set(ours)][:3]
        return f"{len(ours)} rows != {len(theirs)} rows\n   spark {left}\n   sql   {right}"
    return "" if ours else "no rows"


def main():
    import __spark_entry__ as entry
    from searchloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    wrong = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, name, query, oracles[name])
            else:
                problem = "" if query(spark, sf_dir).count() else "no rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        wrong += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:32} {time.time() - start:6.1f}s {problem}", flush=True)
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
