"""From raw change events to typed, checked rows of a contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallylake.contracts import DELETED, LSN, OPERATIONS, TableContract, cast_type, is_uuid
from tallylake.functions.json_text import with_json_value
from tallylake.functions.keys import canonical_uuid
from tallylake.session import COMPACT


class ContractError(ValueError):
    """A batch that does not meet its contract. Nothing of it may be applied."""


#: Each rule of the contract with the condition that counts a line against it.
RULES = (
    "malformed_json", "missing_op", "missing_lsn", "missing_primary_key", "unsupported_op",
    "invalid_values",
)


def extract_envelope(lines: DataFrame, contract: TableContract) -> DataFrame:
    """``extract_envelope_with`` no other columns."""
    return extract_envelope_with(lines, contract, [])


def extract_envelope_with(lines: DataFrame, contract: TableContract, carry: list[str]) -> DataFrame:
    """The columns in ``carry``, and texts of the envelope: ``well_formed``, ``op``, ``lsn``, ``after`` and ``before_key``.

    Every value is the first non-null one of the root path and the ``payload``
    path, so both envelope forms may be mixed. A line is parsed once. It is
    malformed when it isn't exactly one JSON object, or repeats a name.
    """
    body = ",".join(f"`{f.name}`:string" for f in contract.business_fields)
    event = (
        f"op:string,source:struct<lsn:string>,after:struct<{body}>,"
        f"before:struct<`{contract.primary_key}`:string>"
    )
    shape = f"struct<{event},payload:struct<{event}>>"
    # The shape is taken from the parsed text itself; a variant of its own would be built anew from it.
    lines = with_json_value(lines.select("value", *carry), F.col("value"), "e", shape)

    def first(path: str) -> Column:
        return F.coalesce(F.col(f"e.{path}"), F.col(f"e.payload.{path}"))

    after = F.struct(
        *[first(f"after.`{f.name}`").alias(f.name) for f in contract.business_fields]
    )
    return lines.select(
        *carry,
        F.col("e").isNotNull().alias("well_formed"),
        first("op").alias("op"),
        first("source.lsn").alias("lsn"),
        after.alias("after"),
        first(f"before.`{contract.primary_key}`").alias("before_key"),
    )


def recover_delete_key(envelope: DataFrame, contract: TableContract) -> Column:
    """The key text from the after image, else from the before image."""
    return F.coalesce(F.col("after")[contract.primary_key], F.col("before_key"))


def cdc_columns(envelope: DataFrame) -> dict[str, Column]:
    """LSN and tombstone flag of an event."""
    return {
        LSN: F.col("lsn").try_cast("bigint"),
        DELETED: F.col("op") == "d",
    }


#: A time starts with a full date; the cast alone would complete a year, or take a time of day as today's.
FULL_DATE = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([T ].*)?$"


def _typed(raw: Column, column: T.StructField) -> Column:
    if is_uuid(column):
        return canonical_uuid(raw)
    value = raw.try_cast(cast_type(column))
    if isinstance(column.dataType, T.DatetimeType):
        return F.when(raw.rlike(FULL_DATE), value)
    return value


def project_contract(envelope: DataFrame, contract: TableContract) -> DataFrame:
    """Typed contract columns, ``op``, and one flag per rule a line breaks.

    A plain cast would only fail when its column is read, so a later projection
    could hide a bad value. Here each failed conversion is a counted flag.
    """
    key = recover_delete_key(envelope, contract)
    change = cdc_columns(envelope)
    typed, failed = [], []
    for column in contract.business_fields:
        raw = key if column.name == contract.primary_key else F.col("after")[column.name]
        value = _typed(raw, column)
        typed.append(value.alias(column.name))
        if not isinstance(column.dataType, T.StringType) or is_uuid(column):
            failed.append(raw.isNotNull() & value.isNull())
    failed.append(F.col("lsn").isNotNull() & change[LSN].isNull())
    any_failed = failed[0]
    for flag in failed[1:]:
        any_failed = any_failed | flag
    good = F.col("well_formed")
    flags = {
        "malformed_json": ~good,
        "missing_op": good & F.col("op").isNull(),
        "missing_lsn": good & F.col("lsn").isNull(),
        "missing_primary_key": good & key.isNull(),
        "unsupported_op": good & F.col("op").isNotNull() & ~F.col("op").isin(*OPERATIONS),
        "invalid_values": good & any_failed,
    }
    return envelope.select(
        "op",
        *typed,
        change[LSN].alias(LSN),
        change[DELETED].alias(DELETED),
        F.struct(*[flag.alias(rule) for rule, flag in flags.items()]).alias("broken"),
    )


def normalise_events(lines: DataFrame, contract: TableContract) -> DataFrame:
    """Raw lines to typed contract rows with their rule flags."""
    return project_contract(extract_envelope(lines, contract), contract)


def contract_counts(normalised: DataFrame) -> DataFrame:
    """One row: how many lines break each rule, in one pass over the whole batch."""
    return normalised.agg(*[F.count_if(F.col(f"broken.{rule}")).alias(rule) for rule in RULES])


def _raise_on(counts: dict[str, int], table: str) -> None:
    broken = [f"{rule}: {counts[rule]}" for rule in RULES if counts[rule]]
    if broken:
        raise ContractError(f"Batch of {table} breaks its contract: " + "; ".join(broken))


def validate_cdc_batch(normalised: DataFrame, contract: TableContract) -> DataFrame:
    """Fail on any broken rule, else return the rows without their flags."""
    _raise_on(contract_counts(normalised).first().asDict(), contract.name)
    return normalised.drop("broken")


def stage_events(lines: DataFrame, contract: TableContract, path: str) -> DataFrame:
    """Parse a batch once, write it with its rule flags to ``path`` and check it there.

    The check reads the flags only, and later steps read typed columns instead
    of parsing again, so a lost executor costs its tasks only. Raises before
    anything can be applied.
    """
    normalised = normalise_events(lines, contract)
    normalised.write.mode("overwrite").options(**COMPACT).parquet(path)
    written = lines.sparkSession.read.schema(normalised.schema).parquet(path)
    return validate_cdc_batch(written, contract)


def align_to_contract(rows: DataFrame, contract: TableContract) -> DataFrame:
    """Columns in contract order and widened to contract types; required ones must be set.

    ``DataFrame.to`` refuses lossy conversions and missing required columns.
    """
    relaxed = T.StructType(
        [T.StructField(f.name, f.dataType, True, f.metadata) for f in contract.schema.fields]
    )
    missing = [F.col(name).isNull() for name in contract.required]
    any_missing = missing[0]
    for flag in missing[1:]:
        any_missing = any_missing | flag
    checked = F.when(
        any_missing, F.raise_error(F.lit(f"A required column of {contract.name} is NULL."))
    ).otherwise(F.col(contract.primary_key))
    return rows.to(relaxed).withColumn(contract.primary_key, checked)
