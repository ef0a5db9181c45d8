"""Running a registered query and its SQL side by side."""

import collections
import glob
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql: str) -> list[str]:
    """What differs between a Spark result and a SQL result, in names, types or rows."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {r[0]: r[1] for r in described}
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if ours != theirs:
        found.append(f"schema: {sorted(set(ours.items()) ^ set(theirs.items()))}")
    if set(ours) != set(theirs):
        return found
    names = sorted(ours)
    spark_rows = collections.Counter(tuple(r) for r in df.select(*names).collect())
    order = ", ".join(f'"{n}"' for n in names)
    sql_rows = collections.Counter(
        tuple(r) for r in con.execute(f"SELECT {order} FROM ({sql})").fetchall()
    )
    for label, extra in (("spark", spark_rows - sql_rows), ("sql", sql_rows - spark_rows)):
        if extra:
            found.append(f"{label} only: {sum(extra.values())} rows, e.g. {next(iter(extra))}")
    if not spark_rows and not found:
        found.append("no rows")
    return found
