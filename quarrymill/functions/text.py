"""Review text: themes, excerpts, numbers and wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Plural forms that the suffix rules would miss.
IRREGULAR = {"batteries": "battery", "people": "person", "children": "child", "lenses": "lens"}
#: Patterns that an excerpt must not show.
EMAIL, PHONE = r"(?U)[\w.+-]+@[\w-]+(\.[\w-]+)+", r"\+?\d[\d ()-]{7,}\d"
#: What stands in their place.
EMAIL_MASK, PHONE_MASK = "[email removed]", "[number removed]"
#: What a shortened text does not end with before its dots.
LOOSE_ENDS = " ,;:-"

#: How months are written.
MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
#: What has digits but is no figure: dates in digits, days with months, years, periods.
NO_FIGURES = "(?iU)" + "|".join((
    r"\b\d{4}-\d{1,2}(?:-\d{1,2})?\b", r"\b\d{1,2}[/.]\d{1,2}[/.]\d{2,4}\b",
    rf"\b\d{{1,2}}(?:st|nd|rd|th)?\s+(?:of\s+)?{MONTH}\b\.?(?:,?\s+\d{{4}})?", rf"\b{MONTH}\.?\s+\d{{1,2}}(?:st|nd|rd|th)?\b(?:,?\s+\d{{4}})?",
    r"\b(?:19|20)\d{2}\b", r"\b\d+\s*(?:months?|years?|weeks?|days?)\b",
))
#: A number, in the digits 0 to 9, that is no part of a word, and what makes it a percentage.
FIGURE = r"(?iU)(?<![\w.])(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+(?:\.[0-9]+)?)(?!\w)(?:\s*(?:%|per\s?cent\b))?"


def single_spaced(t: Column) -> Column:
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def shorten(t: Column, size: int) -> Column:
    """At most `size` characters, cut before a word and ended by '...'."""
    cut = F.left(t, F.lit(size - 3))
    at_border = F.substring(t, size - 2, 1) == " "
    whole = F.when(at_border, cut).otherwise(F.regexp_replace(cut, r" [^ ]*$", ""))
    return F.when(F.length(t) <= size, t).otherwise(F.concat(F.rtrim(whole, F.lit(LOOSE_ENDS)), F.lit("...")))


def excerpt(t: Column, size: int) -> Column:
    """Single-spaced, contact data masked, shortened."""
    masked = F.regexp_replace(F.regexp_replace(single_spaced(t), EMAIL, EMAIL_MASK), PHONE, PHONE_MASK)
    return shorten(masked, size)


def trim_codes(detail: Column, width: int = 500) -> Column:
    """A list of codes joined by '|', cut after its last whole code within `width` characters."""
    cut = F.left(detail, F.lit(width))
    return F.when(F.length(detail) <= width, detail).otherwise(F.regexp_replace(cut, r"\|[^|]*$", ""))


def theme_stem(w: Column) -> Column:
    """A word without its plural ending."""
    known = F.create_map(*[F.lit(x) for kv in IRREGULAR.items() for x in kv])
    rule = F.when(w.rlike("ies$") & (F.length(w) > 4), F.regexp_replace(w, "ies$", "y")).when(
        w.rlike("s$") & ~w.rlike("(ss|us|is)$") & (F.length(w) > 3), F.regexp_replace(w, "s$", "")
    ).otherwise(w)
    return F.coalesce(F.try_element_at(known, w), rule)


def theme_key(theme: Column) -> Column:
    """Stems in alphabetical order: one key for spellings of a theme."""
    return F.array_join(F.array_sort(F.transform(F.split(single_spaced(F.lower(theme)), " "), theme_stem)), " ")


def figures(t: Column) -> Column:
    """array<struct<value, percent, written>>: the figures of a text; dates, years, periods and parts of codes are none."""
    plain = F.regexp_replace(F.coalesce(t, F.lit("")), NO_FIGURES, " ")
    written = F.regexp_extract_all(plain, F.lit(FIGURE), F.lit(0))

    def read(w: Column) -> Column:
        value = F.regexp_replace(F.regexp_extract(w, r"[\d,.]+", 0), ",", "").cast("double")
        return F.struct(value.alias("value"), w.rlike(r"(?i)(%|per\s?cent)$").alias("percent"), F.trim(w).alias("written"))

    return F.transform(written, read)


def words_found(t: Column, words: list[str]) -> Column:
    """array<string>, distinct, of the listed words that a text uses."""
    pattern = r"(?i)\b(" + "|".join(words) + r")\b"
    return F.array_distinct(F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(1)), F.lower))


def identifiers(t: Column) -> Column:
    """array<string>, distinct, of lower-case snake_case names."""
    return F.array_distinct(F.regexp_extract_all(t, F.lit(r"(?U)(?<!\w)[a-z][a-z0-9]*(?:_[a-z0-9]+)+(?!\w)"), F.lit(0)))
