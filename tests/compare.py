"""Compare a query's rows with those of its SQL, column by column in name order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def duck_rows(sf_dir: str, sql: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    return names, types, cursor.fetchall()


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, sf_dir: str, sql: str) -> str:
    """Empty when equal, else what differs."""
    names, types, rows = duck_rows(sf_dir, sql)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    have, want = bag(spark_df.columns, spark_df.collect()), bag(names, rows)
    if have == want:
        spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
        same = {"VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "DATE": "date"}
        odd = {n: (spark_types[n], t) for n, t in types.items() if same.get(t) != spark_types[n]}
        return f"types {odd}" if odd else ""
    only_have, only_want = have - want, want - have
    return (
        f"{sum(have.values())} and {sum(want.values())} rows; only Spark {list(only_have.items())[:2]}; "
        f"only SQL {list(only_want.items())[:2]}"
    )
