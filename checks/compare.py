"""Run registered queries beside their expected SQL and report differences.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem".split()


def session(cpus: str = "8", partitions: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfwise-checks")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Spares a stack inspection for every column expression built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(rows) -> list[tuple]:
    """Rows in a fixed order; equal values of one type compare equal."""
    return sorted((tuple(r) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    columns = sorted(df.columns)
    ours = normal(df.select(*columns).collect())
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    if sorted(names) != columns:
        return f"columns differ: {sorted(set(names) ^ set(columns))}"
    order = [names.index(c) for c in columns]
    theirs = normal(tuple(r[i] for i in order) for r in relation.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            bad = [(c, u, v) for c, u, v in zip(columns, a, b) if u != v or type(u) != type(v)]
            return f"first difference: {bad[:4]}"
    return None


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from checks import oracle, registry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = session(), database(sf_dir)
    built, sql = registry.queries(), oracle.oracle_sql()
    assert built.keys() == sql.keys(), built.keys() ^ sql.keys()
    failed = 0
    for name in argv[1:] or built:
        start = time.time()
        try:
            df = built[name](spark, sf_dir)
            problem = difference(df, con, sql[name])
            rows = "ok" if problem is None else problem
        except Exception as error:  # noqa: BLE001
            problem = rows = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:36s} {time.time() - start:6.1f}s  {rows}", flush=True)
    print(f"{failed} of {len(argv[1:] or built)} differ", flush=True)
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
