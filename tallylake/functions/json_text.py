"""Texts that must hold exactly one JSON value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_json_value(df: DataFrame, text: Column, name: str, shape: str = "variant") -> DataFrame:
    """Add ``name``: the JSON value of ``text`` as ``shape``, NULL unless the text holds one value of it and nothing else.

    The parser stops behind the first value, so it alone would miss what follows. The text is
    put into a list in front of a mark made of the text's own hash. A text can't hold its own
    hash, so the mark is the list's second item only if the text was one whole value.
    """
    mark = F.concat(F.lit("k"), F.sha2(text.cast("binary"), 256))
    around = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))
    parsed = df.withColumns({"_json": around, "_json_mark": mark})
    whole = F.try_variant_get("_json", "$[1]", "string") == F.col("_json_mark")
    value = F.when(whole, F.try_variant_get("_json", "$[0]", shape))
    return parsed.withColumn(name, value).drop("_json", "_json_mark")
