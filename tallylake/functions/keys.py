"""Keys in one canonical text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CANONICAL = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"

# 32 hexadecimal digits with dashes anywhere, in braces or not.
_BRACED = r"^\{(.*)\}$"
_HEX32 = "^[0-9a-f]{32}$"
_SPLIT32 = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"


def canonical_uuid(text: Column) -> Column:
    """Lowercase 8-4-4-4-12 form of a UUID text; NULL when it is not a UUID."""
    digits = F.replace(F.lower(F.regexp_replace(text, _BRACED, "$1")), F.lit("-"), F.lit(""))
    return F.when(text.rlike(_CANONICAL), text).when(
        digits.rlike(_HEX32), F.regexp_replace(digits, _SPLIT32, "$1-$2-$3-$4-$5")
    )


def canonical_uuid_bytes(raw: Column) -> Column:
    """The same form from 16 raw bytes; NULL for any other length."""
    return F.when(F.octet_length(raw) == 16, canonical_uuid(F.hex(raw)))
