"""Run registered queries against their SQL and compare whole results.

    python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def plain(value):
    """Values of both engines in one form; doubles at ten digits."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def counted(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list]:
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


def difference(spark, sf_dir: str, query, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    df = query(spark, sf_dir)
    ours = counted(df.columns, df.collect())
    names, rows = sql_rows(sf_dir, sql)
    theirs = counted(names, rows)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows vs {sum(theirs.values())}; "
            f"only here {list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}"
        )
    if not ours:
        return "no rows at all"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    bad = 0
    for name, query in e.queries().items():
        if wanted and name not in wanted:
            continue
        sql, start = e.oracle_sql().get(name), time.time()
        try:
            if sql is None:
                verdict = f"no SQL, {query(spark, sf_dir).count()} rows"
            else:
                verdict = difference(spark, sf_dir, query, sql)
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None and sql is not None
        print(f"{name:28} {time.time() - start:6.2f}s {verdict or 'equal'}", flush=True)
    print("differing:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
