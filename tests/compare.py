"""Run registered queries and their SQL side by side: ``python tests/compare.py sf0.01 [name…]``."""

from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET temp_directory = '{tempfile.mkdtemp(prefix='run-', dir='/tmp')}'")
    con.execute("SET memory_limit = '8GB'")
    con.execute("SET max_temp_directory_size = '2GB'")  # a runaway plan ends instead of filling the disk
    for t in TABLES.split():
        if Path(f"{folder}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or v != v:
        return None
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6)
    return v


def bag(rows) -> Counter:
    return Counter(tuple(cell(v) for v in r) for r in rows)


def kind(t: str) -> str:
    t = t.lower()
    if t in {"bigint", "int", "integer", "hugeint", "smallint", "tinyint"}:
        return "int"
    if t.startswith(("double", "float", "decimal")):
        return "float"
    if t.startswith("timestamp"):
        return "timestamp"
    return {"varchar": "string", "text": "string"}.get(t, t)


def differences(spark_df, con, sql: str) -> tuple[list[str], int]:
    """What differs in columns, kinds of types and rows; and how many rows the SQL gives."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    mine_types = {c: kind(t) for c, t in spark_df.dtypes}
    their_types = {row[0]: kind(row[1]) for row in described}
    if set(mine_types) != set(their_types):
        return [f"columns {sorted(mine_types)} != {sorted(their_types)}"], -1
    out = [f"type of {c}: {mine_types[c]} != {their_types[c]}" for c in mine_types if mine_types[c] != their_types[c]]
    cols = sorted(mine_types)
    quoted = ", ".join(f'"{c}"' for c in cols)
    mine = bag(spark_df.select(*cols).collect())
    other = bag(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if mine != other:
        extra, absent = list((mine - other).items()), list((other - mine).items())
        out.append(f"rows {sum(mine.values())} vs {sum(other.values())}; only here {extra[:2]}; only there {absent[:2]}")
    return out, sum(other.values())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from shelfmend.session import local_session

    folder = sys.argv[1] if sys.argv[1].startswith("/") else f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(folder)
    bad = 0
    oracles = oracle_sql()
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                found, rows = differences(df, con, oracles[name])
            else:
                found, rows = [], df.count()
            state = "ok" if not found else "DIFF " + " | ".join(found)
        except Exception as e:  # noqa: BLE001
            state, rows = "ERROR " + str(e)[:700], -1
        bad += not state.startswith("ok")
        print(f"{name:32s} {rows:8d} rows {time.time() - t0:6.2f}s {state}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
