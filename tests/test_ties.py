"""Ties that the SQL leaves open or that rounding decides, on small tables made for them."""

import random
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
from compare import differences, duck

from quarrymill.plans import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries()


def with_lines(folder, rows: list[tuple]):
    """A copy of the smallest tables by reference, with lineitem rows (order, part, supplier, number, quantity, day)."""
    from compare import TABLES

    for t in TABLES:
        if t != "lineitem":
            (folder / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    names = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.timestamp("us"))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    pq.write_table(pa.table(columns, names), folder / "lineitem.parquet")
    return str(folder)


def test_first_of_lines_that_are_alike_is_the_tables_first(spark, tmp_path):
    day, rows = datetime(2000, 1, 1), []
    for part in range(60):  # the first order's line comes twice, from two suppliers, before and after a later order
        rows += [(7, part, part % 10, 3, 1.0, day), (9, part, 4, 2, 1.0, day), (7, part, (part + 1 + part % 7) % 10, 3, 1.0, day)]
    d = with_lines(tmp_path, rows)
    con = duck(d)
    con.execute("SET threads = 1")
    assert differences(QUERIES["first_regions"](spark, d).toPandas(), con.sql(ORACLES["first_regions"]).df()) == []


def at_limit(rng, n: int, rate: float) -> list[int]:
    """n months of whole units whose line ends at exactly `rate` times the mean of the last six (at 0, where these are 0)."""
    while True:
        y = [rng.randrange(50) for _ in range(n)]
        if rate == 0:
            y[-6:] = [0] * 6
        want, rest = round(10 * rate) * n * (n + 1) * sum(y[-6:]), sum(v * (3 * i - n - 1) for i, v in enumerate(y, 1) if i != n // 3)
        if want % 120 == 0 and rest >= want // 120:  # month n / 3 weighs -1
            y[n // 3 - 1] = rest - want // 120
            return y


def test_lines_that_end_at_the_limit_are_flagged_alike(spark, tmp_path):
    rng, n, rows = random.Random(3), 48, []
    series = {part: at_limit(rng, n, (1.3, 0.7, 0)[part % 3]) for part in range(240)}
    for part, y in series.items():
        rows += [(part, part, part % 10, 1, float(v), datetime(1996 + i // 12, i % 12 + 1, 5)) for i, v in enumerate(y)]
    rng.shuffle(rows)
    d = with_lines(tmp_path, rows)
    want = duck(d).sql(ORACLES["trend_audit"]).df()
    assert {round(abs(x), 4) for x in want["pct_diff"].dropna()} == {30.0} and want["pct_diff"].isna().sum() == 80 and want["disconnected"].nunique() == 2
    assert differences(QUERIES["trend_audit"](spark, d).toPandas(), want) == []
