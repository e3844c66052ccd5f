"""Declared contracts of the current-state tables. Nothing is inferred."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LSN = "_cdc_lsn"
DELETED = "_cdc_deleted"
OPERATIONS = ("c", "r", "u", "d")

UUID = "uuid"
MONEY = T.DecimalType(18, 4)
RATE = T.DecimalType(18, 8)


@dataclass(frozen=True)
class TableContract:
    """One current-state table: its key, its typed columns and its value domains.

    ``schema`` ends with the change columns. A UUID column is text with the
    logical type in its metadata, because Spark has no UUID type.
    """

    name: str
    primary_key: str
    schema: T.StructType
    day_column: str | None = None
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def business_fields(self) -> list[T.StructField]:
        return [f for f in self.schema.fields if f.name not in (LSN, DELETED)]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def is_uuid(column: T.StructField) -> bool:
    return column.metadata.get("logical") == UUID


def _contract(name, primary_key, columns, day_column=None, domains=None) -> TableContract:
    fields = []
    for column, kind in columns:
        if kind == UUID:
            fields.append(
                T.StructField(column, T.StringType(), column != primary_key, {"logical": UUID})
            )
        else:
            fields.append(T.StructField(column, kind, column != primary_key))
    fields.append(T.StructField(LSN, T.LongType(), False))
    fields.append(T.StructField(DELETED, T.BooleanType(), False))
    return TableContract(name, primary_key, T.StructType(fields), day_column, domains or {})


_TEXT, _TIME = T.StringType(), T.TimestampType()

# The allowed codes of each domain.
PARTNER_TYPES = ("merchant", "bank", "processor")
PARTNER_STATUSES = ("active", "suspended", "inactive")
CURRENCIES = ("USD", "CAD", "BRL", "EUR", "GBP", "JPY", "CHF")
ACCOUNT_TYPES = ("settlement", "holding", "fee")
ACCOUNT_STATUSES = ("active", "frozen", "closed")
PAYMENT_METHODS = ("wire", "card", "pix", "boleto")
TRANSACTION_STATUSES = ("pending", "authorized", "completed", "voided", "refunded")
EVENT_TYPES = (
    "initiated", "authorized", "captured", "settled", "voided", "refunded", "chargeback",
)
ENTRY_TYPES = ("debit", "credit")

CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in (
        _contract(
            "partners",
            "partner_id",
            [
                ("partner_id", UUID), ("name", _TEXT), ("country", _TEXT),
                ("partner_type", _TEXT), ("status", _TEXT),
                ("created_at", _TIME), ("updated_at", _TIME),
            ],
            domains={"partner_type": PARTNER_TYPES, "status": PARTNER_STATUSES},
        ),
        _contract(
            "accounts",
            "account_id",
            [
                ("account_id", UUID), ("partner_id", UUID), ("currency", _TEXT),
                ("account_type", _TEXT), ("status", _TEXT),
                ("created_at", _TIME), ("updated_at", _TIME),
            ],
            domains={"account_type": ACCOUNT_TYPES, "status": ACCOUNT_STATUSES},
        ),
        _contract(
            "transactions",
            "transaction_id",
            [
                ("transaction_id", UUID), ("source_account_id", UUID),
                ("destination_account_id", UUID), ("amount", MONEY), ("currency", _TEXT),
                ("fx_rate", RATE), ("converted_amount", MONEY), ("converted_currency", _TEXT),
                ("payment_method", _TEXT), ("status", _TEXT), ("description", _TEXT),
                ("created_at", _TIME), ("updated_at", _TIME),
            ],
            day_column="created_at",
            domains={"payment_method": PAYMENT_METHODS, "status": TRANSACTION_STATUSES},
        ),
        _contract(
            "payment_events",
            "event_id",
            [
                ("event_id", UUID), ("transaction_id", UUID), ("event_type", _TEXT),
                ("metadata", _TEXT), ("created_at", _TIME),
            ],
            day_column="created_at",
            domains={"event_type": EVENT_TYPES},
        ),
        _contract(
            "ledger_entries",
            "entry_id",
            [
                ("entry_id", UUID), ("transaction_id", UUID), ("account_id", UUID),
                ("entry_type", _TEXT), ("amount", MONEY), ("currency", _TEXT),
                ("description", _TEXT), ("created_at", _TIME),
            ],
            day_column="created_at",
            domains={"entry_type": ENTRY_TYPES},
        ),
    )
}

_SUPPORTED = (
    T.DecimalType, T.DoubleType, T.TimestampType, T.TimestampNTZType, T.StringType,
    T.IntegerType, T.LongType, T.BooleanType,
)


def cast_type(column: T.StructField) -> T.DataType:
    """The type a change field is cast to. The set is closed: anything else is an error."""
    if not isinstance(column.dataType, _SUPPORTED):
        raise TypeError(f"Type not supported by the change contract: {column.dataType}")
    return T.LongType() if isinstance(column.dataType, T.IntegerType) else column.dataType
