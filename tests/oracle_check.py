"""Compare registered queries with their SQL counterparts; usable as a script: oracle_check.py SF_DIR [NAME ...]."""

import glob
import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def compare(spark, con, sf_dir: str, name: str) -> int:
    """Rows of the query, after checking that names and values equal the SQL result."""
    df = queries()[name](spark, sf_dir)
    expected = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns), (df.columns, expected.columns)
    got = _canonical([tuple(r) for r in df.collect()], df.columns)
    want = _canonical(expected.fetchall(), expected.columns)
    assert len(got) == len(want), (name, len(got), len(want))
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    assert not differing, (name, len(differing), sorted(df.columns), differing[0])
    return len(got)


if __name__ == "__main__":
    from tremorlake.session import builder

    session = builder(**{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"}).master(
        "local[8]").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    database = connect(folder)
    for query in sys.argv[2:] or queries():
        try:
            print("ok  ", query, compare(session, database, folder, query), flush=True)
        except Exception as error:  # a script for people: show every failure, then go on
            print("FAIL", query, str(error)[:1500], flush=True)
