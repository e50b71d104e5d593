"""Compare every named query with its SQL on one scale folder.

    python tools/check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from martflow import oracles, registry  # noqa: E402
from martflow.session import session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


SAME = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    df = registry.QUERIES[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in oracles.SQL:
        return bool(got), f"{len(got)} rows, no SQL"
    rel = con.execute(oracles.SQL[name])
    columns = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = rows_of(columns, rel.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {df.columns} / {columns}"
    odd = [
        f"{c}: {t}/{types[c]}" for c, t in df.dtypes if SAME.get(t) not in (types[c], f"{types[c]}_NS")
    ]
    if odd:
        return False, f"types {odd}"
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return False, f"{len(got)} / {len(want)} rows, first differences {diff}"
    return True, f"{len(got)} rows"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registry.QUERIES)
    spark = session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8",
                                            "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        began = time.time()
        try:
            ok, note = compare(spark, con, folder, name)
        except Exception as e:  # a failing query must not hide the others
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {time.time() - began:6.2f}s {name}: {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
