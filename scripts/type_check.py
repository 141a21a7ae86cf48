"""Compare column types of every query with its DuckDB twin (sf0.001)."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quarry.plans import all_oracles, all_queries  # noqa: E402
from quarry.session import get_session  # noqa: E402
from quarry.sources.tables import TABLES, table_path  # noqa: E402

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "smallint": "SMALLINT", "date": "DATE"}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = get_session("local[4]", shuffle_partitions=4)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{table_path(sf_dir, t)}'")
    qs, orc = all_queries(), all_oracles()
    bad = 0
    for key, sql in orc.items():
        s = dict(qs[key](spark, sf_dir).dtypes)
        rel = con.sql(f"SELECT * FROM ({sql}) LIMIT 0")
        d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        diffs = [(c, s[c], d.get(c)) for c in s if SPARK_TO_DUCK.get(s[c], s[c]) != d.get(c)]
        if diffs:
            bad += 1
            print(key, diffs)
    print("type mismatches:", bad)


if __name__ == "__main__":
    main()
