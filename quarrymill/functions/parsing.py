"""Tolerant parsing of text columns; what cannot be read is null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what a product code starts with.
PRODUCT_CODE = r"(?i)^(DN|UN|EN|AN|DL|UL|EL|D|E|U|A)\d"


def invoice_date(text: Column) -> Column:
    """The last ten characters as YYYY-MM-DD or DD/MM/YYYY."""
    tail = F.right(F.trim(text), F.lit(10))
    shape = F.translate(tail, "123456789", "000000000")
    return F.when(shape == "0000-00-00", F.try_to_date(tail, "yyyy-MM-dd")).when(shape == "00/00/0000", F.try_to_date(tail, "dd/MM/yyyy"))


def quantity(text: Column) -> Column:
    """A number with thousands separators; blank and invalid are null."""
    return F.nullif(F.trim(F.replace(text, F.lit(","), F.lit(""))), F.lit("")).try_cast("double")


def is_product_code(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit(""))).rlike(PRODUCT_CODE)


def clean_text(text: Column) -> Column:
    """Trimmed; null and the words that exports write for it are ''."""
    t = F.trim(F.coalesce(text.cast("string"), F.lit("")))
    return F.when(F.lower(t).isin("nan", "nat", "none"), "").otherwise(t)


def whole_number(text: Column) -> Column:
    """Integer, decimals cut off."""
    return text.try_cast("double").try_cast("int")


def typed_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal with half-even rounding."""
    return F.bround(text.try_cast(f"decimal({precision},{scale + 4})"), scale).cast(f"decimal({precision},{scale})")


def amount(json: Column, path: str) -> Column:
    """A JSON field that is a number or {amount, currencyCode}."""
    return F.coalesce(F.get_json_object(json, f"{path}.amount"), F.get_json_object(json, path)).try_cast("double")


def slug(text: Column, size: int = 40) -> Column:
    """Lower case, words joined by one underscore, at most `size` characters."""
    t = F.translate(F.lower(F.trim(text)), "- ", "__")
    t = F.regexp_replace(F.regexp_replace(t, "[^a-z0-9_]+", ""), "_+", "_")
    return F.left(F.regexp_replace(t, "^_+|_+$", ""), F.lit(size))


def truth(text: Column) -> Column:
    """Whether a text cell is anything but empty, null, 0 or a word for no."""
    t = F.lower(clean_text(text))
    return ~t.isin("", "0", "false", "no", "n")


def region_of_code(code: Column) -> Column:
    """The region that a product code's first letter stands for."""
    c = F.upper(F.left(F.trim(code), F.lit(1)))
    return F.when(c == "D", "UK").when(c == "E", "EU").when(c == "U", "US").when(c == "A", "AU")


def readable(label: Column) -> Column:
    """snake_case as words with a capital."""
    t = F.translate(F.coalesce(label, F.lit("")), "_", " ")
    return F.concat(F.upper(F.left(t, F.lit(1))), F.substring(t, 2, 1000))
