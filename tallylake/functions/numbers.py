"""Exact amounts and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallylake.contracts import MONEY, RATE


def to_rate(value: Column) -> Column:
    """Eight decimals, ties to even."""
    return F.bround(value, 8).cast(RATE)


def to_money(value: Column) -> Column:
    """Four decimals, ties away from zero."""
    return F.round(value, 4).cast(MONEY)


def json_text(text: Column) -> Column:
    """A JSON string with the hexadecimal digits of its control-character escapes in lower case."""
    lowered = text
    for upper, lower in zip("ABCDEF", "abcdef"):
        # An escape begins at a backslash with an even number of them before it.
        lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*\\u00[01]){upper}", f"$1{lower}")
    return F.when(F.contains(text, F.lit("\\u00")), lowered).otherwise(text)


def json_float(value: Column) -> Column:
    """Shortest text of a double: plain digits from 1e-4 up to 1e16, else an exponent.

    A whole number keeps its ``.0``. Spark prints an exponent from 1e7 on and
    below 1e-3, so those texts are spelled out through an exact decimal.
    """
    text = value.cast("string")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), 2, "0"),
    )
    small = _trim_zeros(text.try_cast("decimal(38,22)"))
    large = _trim_zeros(text.try_cast("decimal(38,12)"))
    # Java prints two digits of the smallest double, where one tells it apart.
    least = F.when(value < 0, F.lit("-5e-324")).otherwise(F.lit("5e-324"))
    return (
        F.when(F.abs(value) == F.lit(5e-324), least)
        .when(~F.contains(text, F.lit("E")), text)
        .when(exponent.between(-4, -1), small)
        .when(exponent.between(0, 15), large)
        # Two digits of exponent are the least; three-digit ones are not padded.
        .when(F.abs(exponent) >= 100, F.concat(
            mantissa,
            F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
            F.abs(exponent).cast("string"),
        ))
        .otherwise(scientific)
    )


def _trim_zeros(exact: Column) -> Column:
    trimmed = F.regexp_replace(exact.cast("string"), "0+$", "")
    return F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)
