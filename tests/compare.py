"""Order-free comparison of a Spark result with a DuckDB result."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def _rows(table):
    table = table.select(sorted(table.column_names))
    columns = [[_plain(v) for v in c.to_pylist()] for c in table.columns]
    return sorted(zip(*columns), key=repr), table


def differences(df, con, sql):
    """What differs, as text; empty when both results are equal."""
    ours, left = _rows(df.toArrow())
    theirs, right = _rows(con.execute(sql).to_arrow_table())
    if left.column_names != right.column_names:
        return f"columns {left.column_names} != {right.column_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}"
    kinds = [(f.name, str(f.type), str(right.schema.field(f.name).type)) for f in left.schema
             if not _same_kind(str(f.type), str(right.schema.field(f.name).type))]
    return f"types {kinds}" if kinds else ""


def _same_kind(a, b):
    strings = {"string", "large_string"}
    return a == b or {a, b} <= strings or (a.startswith("timestamp") and b.startswith("timestamp"))
