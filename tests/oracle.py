"""Run SQL with DuckDB on the Parquet tables and compare with a Spark result."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle(sql: str, data: str) -> list[tuple]:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{data}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*' if os.path.isdir(path) else ''}')")
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    return sorted(names), normalized(names, out.fetchall())


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normalized(df.columns, [tuple(r) for r in df.collect()])


def normalized(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cell = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)
