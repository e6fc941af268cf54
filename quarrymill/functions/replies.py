"""Replies of a scorer: JSON that may be fenced, incomplete or out of order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .parsing import slug

SENTIMENTS = ("positive", "neutral", "negative")


def without_fences(text: Column) -> Column:
    """The text inside a Markdown code fence, or the text."""
    return F.trim(F.regexp_replace(F.trim(text), r"(?s)^```[a-zA-Z]*\s*|\s*```$", ""))


def theme_list(text: Column) -> Column:
    """array<string> of a JSON list or a comma list: trimmed, lower case, each once, in order."""
    listed = F.coalesce(F.from_json(text, "array<string>"), F.split(text, ","))
    return F.array_distinct(F.filter(F.transform(listed, lambda x: F.lower(F.trim(x))), lambda x: x != ""))


def normalised(reply: Column) -> Column:
    """struct(sentiment, confidence, themes, area) of a reply; unknown sentiments are neutral, confidence
    is within 0..1 and 0.5 where it cannot be read, six themes at most, the area is a slug."""
    r = F.from_json(without_fences(reply), "sentiment string, confidence string, key_themes array<string>, area string")
    s = F.lower(F.trim(r["sentiment"]))
    confidence = F.least(F.greatest(F.coalesce(r["confidence"].try_cast("double"), F.lit(0.5)), F.lit(0.0)), F.lit(1.0))
    themes = F.slice(F.filter(F.transform(F.coalesce(r["key_themes"], F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x != ""), 1, 6)
    return F.struct(F.when(s.isin(*SENTIMENTS), s).otherwise("neutral").alias("sentiment"), confidence.alias("confidence"), themes.alias("themes"), F.nullif(slug(F.coalesce(r["area"], F.lit(""))), F.lit("")).alias("area"))


def aligned(replies: DataFrame, sizes: DataFrame) -> DataFrame:
    """(batch, slot, position) of replies (batch, position, id) for batches of `size` slots from 1.

    A reply takes the slot of its id, the first of equal ids; replies without a usable id fill the
    empty slots in order; what is left over is dropped, and slots without a reply have a null position.
    """
    slots = sizes.select("batch", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("slot"))
    first = F.row_number().over(Window.partitionBy("batch", "id").orderBy("position"))
    marked = replies.join(sizes, "batch").withColumn("named", F.coalesce(F.col("id").between(1, F.col("size")), F.lit(False)) & (first == 1))
    by_id = slots.join(marked.where("named").select("batch", F.col("id").alias("slot"), "position"), ["batch", "slot"], "left")
    rank = lambda *o: F.row_number().over(Window.partitionBy("batch").orderBy(*o))
    empty = by_id.where("position is null").select("batch", "slot", rank("slot").alias("r"))
    spare = marked.where("not named").select("batch", F.col("position").alias("spare"), rank("position").alias("r"))
    filled = empty.join(spare, ["batch", "r"], "left").select("batch", "slot", "spare")
    return by_id.join(filled, ["batch", "slot"], "left").select("batch", "slot", F.coalesce("position", "spare").alias("position"))
