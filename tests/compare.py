"""Run registered queries beside their SQL in DuckDB and compare all rows."""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])

    def clean(value):
        if isinstance(value, float) and math.isfinite(value):
            return round(value, 9)
        return value

    return Counter(tuple(clean(row[i]) for i in order) for row in rows)


def check(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[int, list[str]]:
    """Row count, and what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if sql is None:
        return sum(got.values()), []
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = rows_of(columns, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(columns):
        problems.append(f"columns {sorted(df.columns)} / {sorted(columns)}")
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    for column, dtype in df.dtypes:
        if same.get(dtype) != kinds.get(column):
            problems.append(f"type of {column}: {dtype} / {kinds.get(column)}")
    if got != want:
        problems.append(
            f"rows {sum(got.values())} / {sum(want.values())}: only here "
            f"{list((got - want).items())[:2]}, only there {list((want - got).items())[:2]}"
        )
    return sum(got.values()), problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from ranktrail.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = get_spark(
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(sf_dir), entry.oracle_sql()
    print("without oracle:", sorted(set(entry.queries()) - set(sql)))
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            count, problems = check(spark, con, sf_dir, name, query, sql.get(name))
        except Exception as error:  # keep going: this is a report
            count, problems = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{'ok ' if not problems else 'BAD'} {name} {count} {time.time() - start:.1f}s")
        for problem in problems:
            print("     ", problem)
