"""Compare a registered query with its SQL on one data folder."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def kind(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return float(value) if isinstance(value, decimal.Decimal) else value
    if isinstance(value, float):
        return "nan" if value != value else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def family(arrow_type) -> str:
    text = str(arrow_type)
    for prefix, name in (("int", "int"), ("uint", "int"), ("double", "float"), ("float", "float"),
                         ("decimal", "decimal"), ("date", "date"), ("timestamp", "timestamp"),
                         ("string", "string"), ("large_string", "string"), ("bool", "bool")):
        if text.startswith(prefix):
            return name
    return text


def rows_of(table):
    names = sorted(table.column_names)
    columns = [[kind(v) for v in table.column(n).to_pylist()] for n in names]
    return names, [family(table.schema.field(n).type) for n in names], Counter(zip(*columns)) if columns else Counter()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark_df, con, sql: str) -> list[str]:
    got = rows_of(spark_df.toArrow())
    expected = rows_of(con.sql(sql).to_arrow_table())
    out = []
    if got[0] != expected[0]:
        return [f"columns {sorted(set(got[0]) ^ set(expected[0]))}"]
    for name, a, b in zip(got[0], got[1], expected[1]):
        if a != b:
            out.append(f"type of {name}: {a} instead of {b}")
    if got[2] != expected[2]:
        extra, missing = got[2] - expected[2], expected[2] - got[2]
        out.append(f"{sum(got[2].values())} rows instead of {sum(expected[2].values())}; "
                   f"{sum(extra.values())} unexpected, {sum(missing.values())} missing")
        out.append(f"names {got[0]}")
        out += [f"unexpected {r}" for r in sorted(extra, key=str)[:3]]
        out += [f"missing {r}" for r in sorted(missing, key=str)[:3]]
    return out
