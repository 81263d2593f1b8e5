"""A query's rows against DuckDB's rows for its SQL."""

import glob
import os

import duckdb


def connection(sf_dir):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS FROM '{path}'")
    return con


def differing(con, df, sql, tmp_path):
    """Rows of one side that the other lacks; columns must be the same."""
    out = str(tmp_path / "rows")
    df.write.parquet(out)
    con.execute(f"CREATE OR REPLACE TEMP TABLE want AS {sql}")
    con.execute(f"CREATE OR REPLACE VIEW got AS FROM '{out}/*.parquet'")
    columns = sorted(r[0] for r in con.execute("DESCRIBE want").fetchall())
    assert columns == sorted(r[0] for r in con.execute("DESCRIBE got").fetchall())
    names = ", ".join(f'"{c}"' for c in columns)
    return con.execute(f"(SELECT {names} FROM want EXCEPT ALL SELECT {names} FROM got) UNION ALL (SELECT {names} FROM got EXCEPT ALL SELECT {names} FROM want)").fetchall()
