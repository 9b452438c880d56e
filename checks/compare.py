"""Run registered queries in both engines and compare rows, types and values.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
FAMILY = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "int", "integer": "int", "hugeint": "int", "float": "double", "varchar": "string", "timestamp_ntz": "timestamp"}


def family(name: str) -> str:
    name = name.lower()
    return FAMILY.get(name, name)


def session() -> SparkSession:
    return (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def key(row: tuple) -> tuple:
    return tuple((v is None, isinstance(v, (datetime.datetime, datetime.date)) and v.isoformat() or v if v is not None else "") for v in row)


def compare(spark: SparkSession, con, sf_dir: str, name: str, build, sql: str | None) -> str:
    started = time.time()
    df = build(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=key)
    took = time.time() - started
    if sql is None:
        return f"ROWS  {name} {len(got)} rows {took:.1f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"COLS  {name} spark={cols} sql={sorted(names)}"
    types = {d[0]: family(str(d[1])) for d in cur.description}
    ours = {n: family(t) for n, t in df.dtypes}
    order = [names.index(c) for c in cols]
    want = sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=key)
    if len(got) != len(want):
        return f"COUNT {name} spark={len(got)} sql={len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    odd = {c: (ours[c], types[c]) for c in cols if ours[c] != types[c]}
    if bad:
        return f"VALUE {name} {len(bad)}/{len(got)} differ; cols={cols}\n   spark={bad[0][0]}\n   sql  ={bad[0][1]}"
    return f"ok    {name} {len(got)} rows {took:.1f}s" + (f" TYPES {odd}" if odd else "")


def main(argv: list[str]) -> int:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:] or list(QUERIES)
    spark = session()
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    failed = 0
    for name in chosen:
        try:
            text = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
        except Exception as err:  # a failing query must not hide the others
            text = f"ERROR {name} {str(err)[:700]}"
        failed += not text.startswith(("ok", "ROWS"))
        print(text, flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
