"""Comparison of a Spark result with a DuckDB result, independent of row order."""

import math

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows(columns, data):
    """Rows with columns sorted by name, themselves sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in data]
    return sorted(out, key=repr)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())


SPARK_TYPE = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}


def duck_schema(con, sql):
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    return {d[0]: SPARK_TYPE.get(d[1], d[1]) for d in desc}
