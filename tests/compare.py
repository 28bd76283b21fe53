"""Row-by-row comparison of Spark results with the SQL oracle."""

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Types that hold the same values on both sides.
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
}


def run_oracle(sql, sf_dir):
    """Column types by name, and the rows as tuples in name order."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    return types, [tuple(row[i] for i in order) for row in result.fetchall()]


def run_spark(df):
    names = sorted(df.columns)
    return {n: TYPE_NAMES[t] for n, t in df.dtypes}, [tuple(r) for r in df.select(*names).collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, v if v is not None else 0) for v in r])
