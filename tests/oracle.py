"""Compare a query with its SQL, both over the tables of one folder."""

import math

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, bool):
        return x
    if hasattr(x, "item"):
        return plain(x.item())
    if isinstance(x, float):
        return round(x, 9) + 0.0
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def by_sql(sql, data=DATA):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    found = con.sql(sql)
    return rows(found.columns, found.fetchall()), dict(zip(found.columns, map(str, found.types)))


def by_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()]), dict(df.dtypes)


KIND = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "FLOAT": "float"}


def difference(df, sql, data=DATA):
    (c1, r1), t1 = by_spark(df)
    (c2, r2), t2 = by_sql(sql, data)
    if c1 != c2:
        return f"columns {c1} != {c2}"
    kinds = [f"{c}: {t1[c]} != {t2[c]}" for c in c1 if KIND.get(t2[c], t2[c]) != t1[c]]
    if kinds:
        return "types " + ", ".join(kinds)
    if len(r1) != len(r2):
        return f"{len(r1)} rows != {len(r2)}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    return f"{len(bad)} of {len(r1)} rows, first {bad[0]}" if bad else None
