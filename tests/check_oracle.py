"""Compare queries with their SQL oracles: `python tests/check_oracle.py SF_DIR [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def normal(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, sf_dir: str, sql: str) -> str | None:
    """None when equal, else what differs."""
    names, rows = oracle_rows(sf_dir, sql)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    want = normal(names, rows)
    if got == want:
        return None if rows else "no rows on either side"
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; extra {list((got - want).items())[:2]}; "
        f"missing {list((want - got).items())[:2]}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            diff = compare(df, sf_dir, oracles[name]) if name in oracles else f"no oracle, {df.count()} rows"
        except Exception as err:  # report and go on with the other queries
            diff = f"{type(err).__name__}: {str(err)[:600]}"
        print(f"\n{'ok  ' if diff is None else 'DIFF'} {name} {time.time() - start:.1f}s {diff or ''}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
