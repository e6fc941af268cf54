"""A query's rows against the rows of its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    return con


def plain(v):
    """A value that compares the same whichever engine gave it."""
    if v is None or v is math.nan or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool":
        return bool(v)
    if hasattr(v, "tolist") and not isinstance(v, (list, str)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 9)
    return v if isinstance(v, (int, str)) else str(v)


def rows(frame) -> tuple[list[str], list[tuple]]:
    names = sorted(frame.columns)
    out = [tuple(plain(v) for v in r) for r in frame[names].itertuples(index=False, name=None)]
    return names, sorted(out, key=lambda r: tuple((x is None, str(type(x).__name__ in ("int", "float", "bool")), x if isinstance(x, (int, float)) else 0, str(x)) for x in r))


def near(a, b) -> bool:
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1.1e-6)
    return a == b


def differences(got, want, most: int = 5) -> list[str]:
    gn, g = rows(got)
    wn, w = rows(want)
    if gn != wn:
        return [f"columns {gn} and {wn}"]
    if len(g) != len(w):
        extra = [x for x in g if x not in set(w)][:2]
        return [f"{len(g)} rows, {len(w)} in SQL; e.g. {extra} {[x for x in w if x not in set(g)][:2]}"]
    return [f"{a} | {b}" for a, b in zip(g, w, strict=True) if not all(map(near, a, b))][:most]
