"""Run registered queries next to their DuckDB statements: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from packetmill.plans.fixtures import BASE_TABLES  # noqa: E402

FAMILIES = {"int64": "bigint", "int32": "int", "float64": "double", "bool": "boolean", "object": "text"}
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "VARCHAR": "string"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Bags of rows must be equal, doubles to the last bit."""
    relation = con.sql(sql)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema}
    duck_types = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        odd = {c: (spark_types.get(c), duck_types.get(c)) for c in {*spark_types, *duck_types}
               if spark_types.get(c) != duck_types.get(c)}
        return f"schema: {odd}"
    names = sorted(spark_types)
    theirs = Counter(con.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall())
    ours = Counter(tuple(r) for r in df.select(*names).collect())
    if ours == theirs:
        return None if ours else "no rows on either side"
    return (f"{sum(ours.values())} rows vs {sum(theirs.values())}; only ours {list((ours - theirs).items())[:3]}; "
            f"only theirs {list((theirs - ours).items())[:3]}")


def main() -> None:
    from packetmill.plans.catalog import ORACLES, QUERIES
    from packetmill.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.001"
    spark = local_session(8)
    con = duck(sf_dir)
    wrong = 0
    for name in args[1:] or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = compare(df, con, ORACLES[name]) if name in ORACLES else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        wrong += problem is not None and not problem.startswith("rows only")
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{wrong} wrong")


if __name__ == "__main__":
    main()
