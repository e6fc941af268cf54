"""Series as rows of arrays, fitted many at a time in Arrow tasks.

A row is a key and its own numbers, so Spark deals the series out and a task holds one Arrow batch of
them. Series of one length are stacked and fitted together by numpy; no state goes from batch to batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def series_rows(grid: DataFrame, least: int) -> DataFrame:
    """grid (key, month, units) to (key, days array<int>, ys array<double>): months as days since 1970, in order.

    Months without a value are left out, and so are series of fewer than `least` months.
    """
    own = F.array_sort(F.collect_list(F.struct(F.unix_date(F.col("month").cast("date")).alias("d"), F.col("units").cast("double").alias("y"))))
    rows = grid.where("units is not null").groupBy("key").agg(own.alias("x")).where(F.size("x") >= least)
    return rows.select("key", F.transform("x", lambda s: s["d"]).alias("days"), F.transform("x", lambda s: s["y"]).alias("ys"))


def fit_alike(rows: DataFrame, alike: list[str], fit: Callable[[dict[str, list]], list[dict]], result: str) -> DataFrame:
    """rows (key, ...) with the columns of `result` (a DDL string of names and types) that fit gives.

    fit gets the columns of rows of a batch that share the lengths of the arrays `alike` (and their
    values, where these are whole numbers), as lists, and returns a dict for each row.
    """
    out = StructType([rows.schema["key"], *StructType.fromDDL(result)])
    arrow = to_arrow_schema(out)

    def shape(values: list) -> tuple:
        return (len(values), *(values if values and isinstance(values[0], int) else ()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = {n: b.column(n).to_pylist() for n in b.schema.names}
            groups: dict[tuple, list[int]] = {}
            for i in range(b.num_rows):
                groups.setdefault(tuple(shape(columns[c][i]) for c in alike), []).append(i)
            made: list[dict] = [{}] * b.num_rows
            for own in groups.values():
                found = fit({n: [v[i] for i in own] for n, v in columns.items()})
                for i, row in zip(own, found, strict=True):
                    made[i] = row
            for i in range(b.num_rows):
                made[i]["key"] = columns["key"][i]
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    # series take far longer to fit than to move, so they are dealt over all cores, however few bytes they are
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "key").mapInArrow(run, out)


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions of many small systems a[i] x[i] = b[i]."""
    return np.linalg.solve(a, b[..., None])[..., 0]
