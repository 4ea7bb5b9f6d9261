"""Run registered queries beside their SQL and compare whole results.

python tests/compare.py <raw dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(raw_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{raw_dir}/{name}.parquet'")
    return con


def canonical(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return f"f{v!r}"
        if hasattr(v, "as_tuple"):
            return f"f{float(v)!r}"
        return f"{type(v).__name__}:{v}"

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = canonical(cursor.fetchall(), names)
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(set(names) ^ set(spark_df.columns))}"
    got = canonical(spark_df.collect(), spark_df.columns)
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:2]
    missing = [r for r in want if r not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}\n   spark only {extra}\n   sql only   {missing}"


def main() -> None:
    raw_dir, chosen = sys.argv[1], sys.argv[2:]
    import __spark_entry__ as entry
    from matricula.session import build_session

    spark, con = build_session(cpus="8"), duck(raw_dir)
    sql = entry.oracle_sql()
    print("== no sql:", sorted(set(entry.queries()) - set(sql)), "no query:", sorted(set(sql) - set(entry.queries())))
    bad = []
    for name, query in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = query(spark, raw_dir)
            verdict = compare(df, con, sql[name]) if name in sql else f"(no sql) {df.count()} rows"
        except Exception as problem:  # noqa: BLE001
            verdict = f"{type(problem).__name__}: {str(problem)[:900]}"
        if verdict and not verdict.startswith("(no sql)"):
            bad.append(name)
        print(f"== {name:36s} {time.time() - start:6.2f}s {verdict or 'ok'}", flush=True)
    print(f"== differing: {bad}")


if __name__ == "__main__":
    main()
