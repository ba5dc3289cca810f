"""Order-insensitive comparison of query results (used by tests and scripts)."""

from __future__ import annotations

import hashlib
import math


def norm(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return f"{v:.6g}"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    return str(v)


def digest(cols, rows) -> str:
    """Hash of a multiset of rows, columns taken in name order."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    hs = sorted(hashlib.md5("|".join(norm(r[i]) for i in order).encode()).hexdigest() for r in rows)
    return hashlib.md5("".join(hs).encode()).hexdigest()


def duck_views(con, sf_dir: str, tables) -> None:
    for t in tables:
        con.execute(f"create or replace view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
