"""Aircraft snapshots: integrity, then one typed observation per state vector.

A snapshot is one JSON object of at most some tens of thousands of vectors, so
it is judged as a whole inside its own row; no shuffle brings its vectors back
together.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallylake.functions.clock import (
    MAX_SECOND, MIN_SECOND, has_offset, iso_utc, iso_utc_of_seconds, utc_clock,
)
from tallylake.functions.json_text import with_json_value
from tallylake.functions.numbers import json_float, json_text
from tallylake.functions.text import strip

# Fixed values: (position, name, kind, nullable) of a state vector.
TEXT, WHOLE, SECOND, NUMBER, FLAG, WHOLE_LIST = "text", "whole", "second", "number", "flag", "list"
POSITIONS = (
    (0, "icao24", TEXT, False),
    (1, "callsign", TEXT, True),
    (2, "origin_country", TEXT, False),
    (3, "time_position", SECOND, True),
    (4, "last_contact", SECOND, True),
    (5, "longitude", NUMBER, True),
    (6, "latitude", NUMBER, True),
    (7, "baro_altitude", NUMBER, True),
    (8, "on_ground", FLAG, False),
    (9, "velocity", NUMBER, True),
    (10, "true_track", NUMBER, True),
    (11, "vertical_rate", NUMBER, True),
    (12, "sensors", WHOLE_LIST, True),
    (13, "geo_altitude", NUMBER, True),
    (14, "squawk", TEXT, True),
    (15, "spi", FLAG, False),
    (16, "position_source", WHOLE, False),
    (17, "category", WHOLE, True),
)
LENGTHS = (17, 18)
_ALLOWED = {
    TEXT: ["STR"], WHOLE: ["BIG"], SECOND: ["BIG"], NUMBER: ["BIG", "DEC", "DOU", "FLO"],
    FLAG: ["BOO"], WHOLE_LIST: ["ARR"],
}
#: Columns that hold the vectors of a snapshot as read.
_VECTORS = ("states", "state_texts", "state_places")
ICAO24 = r"^[0-9a-fA-F]{6}\z"
SCHEMA_VERSION, SOURCE = 1, "opensky"


# --- one JSON value ------------------------------------------------------------------

def _at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def _kind(value: Column) -> Column:
    """Type name of a scalar: BIGINT, DECIMAL(..), DOUBLE, STRING, BOOLEAN or VOID for null."""
    return F.schema_of_variant(value)


def _is_null(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def _is_whole(value: Column) -> Column:
    return _kind(value) == "BIGINT"


def _elements(value: Column) -> Column:
    """The elements of a JSON list; NULL for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


# --- snapshots -----------------------------------------------------------------------

def inspect_snapshots(objects: DataFrame) -> DataFrame:
    """Add size, checksum, ``source_time``, ``states``, their texts, ``state_count`` and ``refusal``.

    ``objects`` has ``content``. The body must be a JSON object with a whole
    number ``time`` and ``states`` a list or null; null counts as empty. Text
    behind the object is refused. ``state_texts`` are the vectors as compact JSON,
    ``state_places`` the places of those that are lists, as texts.
    """
    text = F.try_validate_utf8(F.col("content").cast("string"))
    parsed = with_json_value(objects, text, "body")
    time, states = _at(F.col("body"), "$.time"), _at(F.col("body"), "$.states")
    is_object = F.try_variant_get("body", "$", "map<string,variant>").isNotNull()
    elements = F.when(_is_null(states), F.array().cast("array<variant>")).otherwise(
        _elements(states)
    )
    texts = F.from_json(text, "states ARRAY<STRING>")["states"]
    places = F.from_json(text, "states ARRAY<ARRAY<STRING>>")["states"]
    shaped = parsed.select(
        "*",
        texts.alias("state_texts"),
        places.alias("state_places"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"),
        is_object.alias("is_object"),
        F.when(is_object & _is_whole(time), time.try_cast("bigint")).alias("source_time"),
        F.when(is_object, elements).alias("states"),
    )
    refusal = (
        F.when(F.col("body").isNull(), "invalid_json")
        .when(~F.col("is_object"), "not_an_object")
        .when(F.col("source_time").isNull(), "invalid_time")
        .when(F.col("states").isNull(), "invalid_states")
    )
    return shaped.withColumn("refusal", refusal).select(
        *objects.columns,
        "size_bytes",
        "sha256",
        "source_time",
        "states",
        "state_texts",
        "state_places",
        F.when(F.col("refusal").isNull(), F.size("states")).cast("bigint").alias("state_count"),
        "refusal",
    )


def snapshot_catalog(objects: DataFrame) -> DataFrame:
    """What the collector records of each raw snapshot."""
    return inspect_snapshots(objects).select(
        "object_key", "source_time", "state_count", "size_bytes", "sha256", "refusal"
    )


def metadata_value(name: str) -> Column:
    """A non-empty metadata value; names ignore case and an ``x-amz-meta-`` prefix."""
    def named(entry: Column) -> Column:
        bare = F.regexp_replace(F.lower(entry["key"]), "^x-amz-meta-", "")
        return (bare == name) & (entry["value"] != "")

    return F.try_element_at(F.filter(F.map_entries("metadata"), named), F.lit(1))["value"]


def verify_snapshots(objects: DataFrame) -> DataFrame:
    """Compare each snapshot with its recorded metadata; the first difference is its ``refusal``.

    ``objects`` has object_key, content, metadata and stored_size.
    """
    seen = inspect_snapshots(objects)
    names = {
        "sha256": "meta_sha256", "source-time": "meta_source_time",
        "state-count": "meta_state_count", "collected-at": "meta_collected_at",
        "snapshot-id": "snapshot_id", "request-id": "request_id",
    }
    seen = seen.withColumns({alias: metadata_value(name) for name, alias in names.items()})
    collected = F.col("meta_collected_at").try_cast("timestamp")

    def missing(alias: str) -> Column:
        return F.col(alias).isNull()

    refusal = (
        F.when(missing("meta_sha256"), "missing_sha256")
        .when(F.col("sha256") != F.col("meta_sha256"), "checksum_differs")
        .when(F.col("stored_size") != F.col("size_bytes"), "size_differs")
        .when(F.col("refusal").isNotNull(), F.col("refusal"))
        .when(missing("meta_source_time"), "missing_source_time")
        .when(F.col("source_time").cast("string") != F.col("meta_source_time"), "time_differs")
        .when(missing("meta_state_count"), "missing_state_count")
        .when(F.col("state_count").cast("string") != F.col("meta_state_count"), "count_differs")
        .when(missing("meta_collected_at"), "missing_collected_at")
        .when(collected.isNull(), "invalid_collected_at")
        .when(~has_offset(F.col("meta_collected_at")), "collected_at_without_offset")
        .when(missing("snapshot_id"), "missing_snapshot_id")
        .when(missing("request_id"), "missing_request_id")
    )
    return seen.withColumn("refusal", refusal).select(
        "object_key",
        "snapshot_id",
        "request_id",
        F.when(has_offset(F.col("meta_collected_at")), iso_utc(utc_clock(collected))).alias(
            "collected_at"
        ),
        "source_time",
        "sha256",
        "state_count",
        "states",
        "state_texts",
        "state_places",
        "refusal",
    )


# --- state vectors -------------------------------------------------------------------

def _cells(vector: Column) -> Column:
    """The places of a vector: value, and the first three letters of its type; VOI for a JSON null."""
    return F.transform(_elements(vector), lambda value: F.struct(
        value.alias("v"), F.substring(F.coalesce(_kind(value), F.lit("VOID")), 1, 3).alias("k")
    ))


def _read_vectors(vectors: Column, make: Callable[[Column, Column], Column]) -> Column:
    """``make(vector, cells)`` of every vector of a list. A vector is taken apart once, whatever is made of it."""
    apart = F.transform(vectors, lambda vector: F.struct(vector.alias("vector"), _cells(vector).alias("cells")))
    return F.transform(apart, lambda read: make(read["vector"], read["cells"]))


def _read_vector(vector: Column, make: Callable[[Column, Column], Column]) -> Column:
    return F.get(_read_vectors(F.array(vector), make), F.lit(0))


def _value(cells: Column, position: int) -> Column:
    return F.get(cells, F.lit(position))["v"]


def _type(cells: Column, position: int) -> Column:
    return F.coalesce(F.get(cells, F.lit(position))["k"], F.lit("VOI"))


_SQL_TYPE = {TEXT: "string", WHOLE: "bigint", SECOND: "bigint", NUMBER: "double", FLAG: "boolean", WHOLE_LIST: "array<bigint>"}


def _typed(cells: Column, position: int, kind: str) -> Column:
    return F.try_variant_get(_value(cells, position), "$", _SQL_TYPE[kind])


def _fault(cells: Column) -> Column:
    def fault(position: int, name: str, kind: str, nullable: bool) -> Column:
        bad = ~_type(cells, position).isin(*_ALLOWED[kind], *(["VOI"] if nullable else []))
        typed = _typed(cells, position, kind)
        if kind == SECOND:
            bad = bad | ~F.coalesce(typed.between(MIN_SECOND, MAX_SECOND), F.lit(True))
        if kind == NUMBER:
            bad = bad | F.coalesce(F.abs(typed) == float("inf"), F.lit(False))
        if kind == WHOLE_LIST:
            items = _elements(_value(cells, position))
            bad = bad | F.coalesce(F.exists(items, lambda item: ~_is_whole(item)), F.lit(False))
        return F.when(bad, F.lit(f"invalid_{name}"))

    size = F.coalesce(F.size(cells), F.lit(-1))
    icao24 = strip(_typed(cells, 0, TEXT))
    faults = [fault(*position) for position in POSITIONS]
    return F.when(~size.isin(*LENGTHS), F.lit("invalid_length")).otherwise(
        F.coalesce(
            faults[0],
            F.when(~icao24.rlike(ICAO24), F.lit("invalid_icao24")),
            faults[12],
            *faults[1:12],
            *faults[13:],
        )
    )


def vector_fault(vector: Column) -> Column:
    """Why a state vector is invalid, NULL when it is valid.

    Types are strict: a number written as text is refused, and so is a boolean
    where a number belongs.
    """
    return _read_vector(vector, lambda _, cells: _fault(cells))


def _event_id(vector: Column, cells: Column) -> Column:
    def compact(position: int, kind: str) -> Column:
        value = _value(cells, position)
        text = F.to_json(value)
        if kind == TEXT:
            text = json_text(text)
        if kind == NUMBER:
            # Numbers print without a whole float's fraction, and in another exponent form.
            plain = F.contains(text, F.lit(".")) & ~F.contains(text, F.lit("E"))
            plain = plain & (F.abs(value.try_cast("double")) >= 1e-4)
            same = (text == "null") | plain | (_type(cells, position) == "BIG")
            text = F.when(same, text).otherwise(json_float(value.try_cast("double")))
        return F.coalesce(text, F.lit("null"))

    def prints_alike(position: int) -> Column:
        number, kind = _typed(cells, position, NUMBER), _type(cells, position)
        return kind.isin("BIG", "VOI") | ((kind == "DEC") & (number != F.floor(number)) & (F.abs(number) >= 1e-4))

    numbers = [prints_alike(position) for position, _, kind, _ in POSITIONS if kind == NUMBER]
    parts = [compact(position, kind) for position, _, kind, _ in POSITIONS]
    last = F.when(F.size(cells) == LENGTHS[1], F.concat(F.lit(","), parts[-1])).otherwise(F.lit(""))
    by_place = F.concat(F.lit("["), F.concat_ws(",", *parts[:-1]), last, F.lit("]"))
    # Where all numbers print as Python prints them, the vector is printed as a whole.
    whole = F.when(reduce(Column.__and__, numbers), json_text(F.to_json(vector)))
    return F.sha2(F.coalesce(whole, by_place), 256)


def state_event_id(vector: Column) -> Column:
    """SHA-256 of the vector's compact JSON, so a vector keeps its id in every snapshot.

    The raw values count: text is not trimmed and a whole float keeps its ``.0``.
    """
    return _read_vector(vector, _event_id)


def explode_states(snapshots: DataFrame) -> DataFrame:
    """One row per state vector; an empty snapshot gives none.

    The outer form with a filter after it: for the plain form Spark adds a size
    condition and pushes it below the parsing, where it parses every body again.
    """
    kept = [c for c in snapshots.columns if c not in (*_VECTORS, "typed")]
    exploded = snapshots.select(*kept, F.posexplode_outer("states").alias("position", "vector"))
    return exploded.where(F.col("position").isNotNull())


#: What a place of a plain vector looks like as compact JSON: no escapes, no exponents, whole numbers well inside 64 bits.
_WHOLE, _STRING = r"-?\d{1,18}", r'"[^"\\\x00-\x1f]*"'
_PLAIN = {
    TEXT: _STRING, WHOLE: _WHOLE, SECOND: r"(?:\d{1,11}|-\d{1,10})", NUMBER: r"-?\d{1,15}(?:\.\d{1,17})?", FLAG: "(?:true|false)",
    WHOLE_LIST: rf"\[(?:{_WHOLE}(?:,{_WHOLE})*)?\]",
}


def _plain_vector() -> str:
    """A pattern of valid vectors whose text Python would write alike; what doesn't fit it may be valid yet."""
    def place(name: str, kind: str, nullable: bool) -> str:
        form = '"[0-9a-fA-F]{6}"' if name == "icao24" else _PLAIN[kind]
        return f"(?:null|{form})" if nullable else form

    places = [place(name, kind, nullable) for _, name, kind, nullable in POSITIONS]
    return r"^\[" + ",".join(places[: LENGTHS[0]]) + f"(?:,{places[-1]})?" + r"\]\z"


PLAIN_VECTOR = _plain_vector()


def _read_text(strings: Column, position: int, kind: str) -> Column:
    text = F.get(strings, F.lit(position))
    if kind != WHOLE_LIST:
        return text.try_cast(_SQL_TYPE[kind])
    items = F.split(F.btrim(text, F.lit("[]")), ",").try_cast(_SQL_TYPE[kind])
    return F.when(text == "[]", F.array().cast(_SQL_TYPE[kind])).otherwise(items)


def typed_states(snapshots: DataFrame) -> DataFrame:
    """Add ``typed``: for each vector its fault, its event id and a typed value for every place (of no use where there is a fault).

    This is the one pass over the vectors; faults, ids and observations are read from it. One pattern
    tells plain vectors, which have no fault and are their own compact JSON; only others are judged
    place by place.
    """
    if "typed" in snapshots.columns:
        return snapshots

    def apart(vector: Column, at: Column) -> Column:
        text, strings = F.get("state_texts", at), F.get("state_places", at)
        # A vector may also be a text that only looks like one; then it has no places.
        plain = F.coalesce(text.rlike(PLAIN_VECTOR) & strings.isNotNull(), F.lit(False))
        return F.struct(vector.alias("vector"), F.when(plain, text).alias("text"), strings.alias("strings"))

    def typed(given: Column) -> Column:
        text = given["text"]
        of_text = [_read_text(given["strings"], position, kind).alias(name) for position, name, kind, _ in POSITIONS]
        plain = F.struct(F.lit(None).cast("string").alias("fault"), F.sha2(text, 256).alias("event_id"), *of_text)

        def judged(vector: Column, cells: Column) -> Column:
            of_cells = [_typed(cells, position, kind).alias(name) for position, name, kind, _ in POSITIONS]
            return F.struct(_fault(cells).alias("fault"), _event_id(vector, cells).alias("event_id"), *of_cells)

        return F.when(text.isNotNull(), plain).otherwise(_read_vector(given["vector"], judged))

    return snapshots.withColumn("typed", F.transform(F.transform("states", apart), typed))


def _accepted(snapshots: DataFrame) -> DataFrame:
    """Snapshots with the vectors of refused ones removed.

    Not a filter, for the reason given in ``explode_states``.
    """
    return snapshots.withColumn("typed", F.when(F.col("refusal").isNull(), F.col("typed")))


def _explode_typed(snapshots: DataFrame) -> DataFrame:
    kept = [c for c in snapshots.columns if c not in (*_VECTORS, "typed")]
    exploded = snapshots.select(*kept, F.posexplode_outer("typed").alias("position", "state"))
    return exploded.where(F.col("position").isNotNull())


def invalid_states(snapshots: DataFrame) -> DataFrame:
    """(object_key, position, fault) of every invalid vector."""
    vectors = _explode_typed(_accepted(typed_states(snapshots)))
    return vectors.select("object_key", "position", F.col("state.fault").alias("fault")).where("fault IS NOT NULL")


def refuse_invalid(snapshots: DataFrame) -> DataFrame:
    """Give a verified snapshot the fault of its first invalid vector as ``refusal``; its vectors get ``typed``."""
    faults = F.filter(F.col("typed.fault"), lambda fault: fault.isNotNull())
    first = F.try_element_at(faults, F.lit(1))
    return typed_states(snapshots).withColumn("refusal", F.coalesce(F.col("refusal"), first))


def state_events(snapshots: DataFrame, bucket: str = "bronze") -> DataFrame:
    """Named observations of the snapshots that have no ``refusal``.

    A snapshot with one invalid vector gives no observation at all, so apply
    ``refuse_invalid`` first.
    """
    rows = _explode_typed(_accepted(typed_states(snapshots)))

    def place(name: str) -> Column:
        return F.col(f"state.{name}")

    return rows.select(
        F.lit(SCHEMA_VERSION).cast("bigint").alias("schema_version"),
        place("event_id"),
        F.lit(SOURCE).alias("source"),
        "request_id",
        "snapshot_id",
        "source_time",
        F.col("collected_at").alias("ingested_at"),
        F.lit(bucket).alias("source_bucket"),
        F.col("object_key").alias("source_object_key"),
        F.col("sha256").alias("source_checksum"),
        F.lower(strip(place("icao24"))).alias("icao24"),
        strip(place("callsign")).alias("callsign"),
        strip(place("origin_country")).alias("origin_country"),
        iso_utc_of_seconds(place("time_position")).alias("observed_at"),
        iso_utc_of_seconds(place("last_contact")).alias("last_contact_at"),
        place("longitude"),
        place("latitude"),
        place("baro_altitude").alias("baro_altitude_m"),
        place("on_ground"),
        place("velocity").alias("velocity_m_s"),
        place("true_track").alias("true_track_deg"),
        place("vertical_rate").alias("vertical_rate_m_s"),
        place("sensors"),
        place("geo_altitude").alias("geo_altitude_m"),
        strip(place("squawk")).alias("squawk"),
        place("spi"),
        place("position_source"),
        place("category"),
    )


def dedup_observations(events: DataFrame) -> DataFrame:
    """One row per event id: the one collected first, whatever the row order."""
    order = Window.partitionBy("event_id").orderBy("ingested_at", "source_object_key")
    ranked = events.withColumn("_rank", F.row_number().over(order))
    return ranked.where("_rank = 1").drop("_rank")


def observation_records(events: DataFrame) -> DataFrame:
    """Message key and JSON value of each observation; nulls are kept."""
    value = F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"})
    return events.select(F.col("icao24").alias("key"), value.alias("value"))


class PublishError(RuntimeError):
    """Snapshots were refused, and the caller asked for all or nothing."""


def publish_observations(
    snapshots: DataFrame, work: str, fmt: str = "kafka", strict: bool = False, **options: str
) -> DataFrame:
    """Publish the observations of accepted snapshots; return (object_key, refusal) of the refused ones.

    A snapshot is published as a whole or not at all. Snapshots are judged once and written to the
    folder ``work``, which publishing and the result read. ``strict`` publishes nothing if any snapshot is
    refused. The sink's own acknowledgement ends the job; a failed task fails the call.
    """
    rows = _accepted(refuse_invalid(snapshots)).drop(*_VECTORS)
    rows.write.mode("overwrite").parquet(work)
    written = rows.sparkSession.read.schema(rows.schema).parquet(work)
    refused = written.where("refusal IS NOT NULL").select("object_key", "refusal")
    if strict:
        counts = refused.groupBy("refusal").count().orderBy("refusal").collect()
        if counts:
            raise PublishError("Snapshots refused: " + "; ".join(f"{r.refusal}: {r['count']}" for r in counts))
    observation_records(state_events(written)).write.format(fmt).options(**options).mode("append").save()
    return refused
