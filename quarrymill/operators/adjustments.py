"""Adjustments that a client enters by hand: checking them, and what they mean for each item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The types of an adjustment.
TYPES = (
    "demand_multiplier", "demand_override", "pinned_order", "stock_override", "open_po_override",
    "cover_override", "lot_override", "discontinue", "delay_orders",
)
BY_MONTH = ("demand_multiplier", "demand_override", "pinned_order", "discontinue")  # those that a month may limit
FIELDS = ("marketplace", "asin", "month_start", "type", "value", "note", "valid_until")


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))


def read_adjustments(raw: DataFrame) -> DataFrame:
    """Typed rows of an entered table (FIELDS as text, and line), with the column problem.

    problem names what is wrong with a row and is null where nothing is. Rows without an item are
    left out. A month is that of its date; numbers may have thousands separators.
    """
    number = F.expr("try_cast(replace(trim(value), ',', '') as double)")
    month, until = (F.expr(f"cast(try_to_timestamp(nullif(trim({c}), ''), 'yyyy-MM-dd') as date)") for c in ("month_start", "valid_until"))
    given = {c: _text(c) != "" for c in ("month_start", "valid_until")}
    kind = _text("type")
    checks = [
        F.when(~kind.isin(*TYPES), F.concat(F.lit("unknown type '"), kind, F.lit("'"))),
        F.when(kind.isin(*TYPES) & (kind != "discontinue") & number.isNull(), F.concat(F.lit("type "), kind, F.lit(" needs a number"))),
        F.when((kind == "pinned_order") & ~given["month_start"], F.lit("pinned_order needs a month")),
        F.when(given["month_start"] & month.isNull(), F.lit("month_start is not a date")),
        F.when(given["valid_until"] & until.isNull(), F.lit("valid_until is not a date")),
        F.when((kind == "demand_multiplier") & (number < 0), F.lit("a multiplier cannot be negative")),
    ]
    return raw.where(_text("asin") != "").select(
        F.col("line"), F.upper(_text("marketplace")).alias("market"), _text("asin").alias("key"), F.trunc(month, "month").alias("month"), kind.alias("type"),
        number.alias("value"), _text("note").alias("note"), until.alias("until"), F.nullif(F.concat_ws("; ", *checks), F.lit("")).alias("problem"),
    )


def usable_adjustments(rows: DataFrame, market: str, first_month: str, most_shown: int = 20) -> DataFrame:
    """The rows of read_adjustments for a market that are valid on first_month; any problem is an error."""
    wrong = rows.where("problem is not null").orderBy("line").limit(most_shown).collect()
    if wrong:
        raise ValueError("; ".join(f"line {r['line']}: {r['problem']}" for r in wrong))
    fits = (F.col("market") == "") | (F.col("market") == market.upper())
    return rows.where(fits & (F.col("until").isNull() | (F.col("until") >= F.lit(first_month).cast("date")))).drop("problem")


def short_number(v: Column) -> Column:
    """A number with six significant digits at most, without trailing zeros."""
    size = F.floor(F.log10(F.abs(v))).cast("int")
    plain = F.format_string("%.6f", F.when(v == 0, F.lit(0.0)).otherwise(F.expr("0D") + v))
    digits = F.when(size >= 5, F.format_string("%.0f", v))
    for n, whole in ((1, 4), (2, 3), (3, 2), (4, 1), (5, 0)):
        digits = digits.when(size == whole, F.format_string(f"%.{n}f", v))
    for n, below in ((6, -1), (7, -2), (8, -3), (9, -4)):
        digits = digits.when(size == below, F.format_string(f"%.{n}f", v))
    digits = F.when(v == 0, plain).otherwise(digits)
    cut = F.when(digits.contains("."), F.regexp_replace(digits, r"\.?0+$", "")).otherwise(digits)
    far = F.regexp_replace(F.format_string("%.5e", v), r"\.?0*e", "e")
    return F.when((v != 0) & ((size < -4) | (size > 5)), far).otherwise(cut)


def label(kind: Column, month: Column, value: Column, note: Column) -> Column:
    """An adjustment as a reader sees it, for example `pinned_order 2026-11 300 (container 2)`."""
    note = F.when(F.trim(note) != "", F.concat(F.lit("("), note, F.lit(")")))
    return F.concat_ws(" ", kind, F.date_format(month, "yyyy-MM"), short_number(value), note)


def by_item(rows: DataFrame, first_month: str, horizon: int) -> DataFrame:
    """One row an item: (key, multipliers, overrides, pinned, stock, open_po, cover, lot, stop_from, delay, notes).

    The first three are arrays over the months of the forecast. Multipliers multiply; of overrides the
    last line counts; pinned orders add up; orders stop at the earliest month. Lines of a month outside
    the forecast are passed over. An item's lines are few, as people enter them.
    """
    step = F.months_between("month", F.lit(first_month).cast("date")).cast("int")
    inside = F.col("month").isNull() | step.between(0, horizon - 1)
    used = rows.where(~F.col("type").isin(*BY_MONTH) | inside)
    made = F.struct("line", "type", "value", step.alias("step"), label(F.col("type"), F.col("month"), F.col("value"), F.col("note")).alias("label"))
    held = used.groupBy("key").agg(F.array_sort(F.collect_list(made)).alias("x"))
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))

    def of(kind: str, h: Column | None = None) -> Column:
        def fits(x: Column) -> Column:
            return (x["type"] == kind) if h is None else (x["type"] == kind) & (x["step"].isNull() | (x["step"] == h))

        return F.transform(F.filter("x", fits), lambda x: x["value"])

    def last(values: Column) -> Column:
        return F.try_element_at(values, F.lit(-1))

    stops = F.transform(F.filter("x", lambda x: x["type"] == "discontinue"), lambda x: F.coalesce(x["step"], F.lit(0)))
    return held.select(
        "key",
        F.transform(steps, lambda h: F.aggregate(of("demand_multiplier", h), F.lit(1.0), lambda a, v: a * v)).alias("multipliers"),
        F.transform(steps, lambda h: last(of("demand_override", h))).alias("overrides"),
        F.transform(steps, lambda h: F.aggregate(of("pinned_order", h), F.lit(0.0), lambda a, v: a + v)).alias("pinned"),
        *(last(of(f"{c}_override")).alias(c) for c in ("stock", "open_po", "cover", "lot")),
        F.array_min(stops).alias("stop_from"), F.coalesce(F.bround(last(of("delay_orders"))).cast("int"), F.lit(0)).alias("delay"),
        F.array_join(F.transform("x", lambda x: x["label"]), "; ").alias("notes"),
    )
