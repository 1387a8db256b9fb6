"""Compare a registered query with its oracle SQL as multisets of typed rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DOUBLE": "double",
}


def duck(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    rel = con.sql(sql)
    types = {
        c: DUCK_TYPES.get(str(t), str(t).lower()) for c, t in zip(rel.columns, rel.types)
    }
    return types, sorted_rows(rel.columns, rel.fetchall())


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, query, sql: str) -> tuple[int, str]:
    """Row count and a description of the first difference (empty if none)."""
    df = query(spark, sf_dir)
    mine_types = {f.name: f.dataType.simpleString().replace(" ", "") for f in df.schema.fields}
    types, theirs = duck(sf_dir, sql)
    types = {c: t.replace(" ", "") for c, t in types.items()}
    if types != mine_types:
        diff = {c: (mine_types.get(c), types.get(c)) for c in {*types, *mine_types}
                if types.get(c) != mine_types.get(c)}
        return len(theirs), f"types {diff}"
    mine = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if len(mine) != len(theirs):
        return len(theirs), f"rows {len(mine)} != {len(theirs)}"
    for m, t in zip(mine, theirs):
        if m != t:
            return len(theirs), f"{m} != {t}"
    return len(theirs), ""
