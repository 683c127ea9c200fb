"""Raw messages to validated records plus a dead-letter output, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P

_CODE = f"""CASE WHEN __usual THEN NULL
    WHEN __fields IS NULL THEN CASE WHEN {P.is_json('__raw')} THEN 'NOT_OBJECT'
        ELSE 'JSON_PARSE' END
    WHEN __missing <> '' THEN 'MISSING_FIELDS'
    WHEN __value IS NULL THEN 'NON_NUMERIC'
    WHEN NOT {P.is_finite('__value')} THEN 'NON_FINITE'
    WHEN __time IS NULL THEN 'BAD_TIMESTAMP' END"""

_REASON = f"""CASE reason_code
    WHEN 'JSON_PARSE' THEN '{P.JSON_PARSE}: malformed text'
    WHEN 'NOT_OBJECT' THEN '{P.NOT_OBJECT}'
    WHEN 'MISSING_FIELDS' THEN concat('{P.MISSING_FIELDS}: {{', __missing, '}}')
    WHEN 'NON_NUMERIC' THEN
        concat('{P.NON_NUMERIC}: ', {P.quoted('__number_field', '__fields.value')})
    WHEN 'NON_FINITE' THEN concat('{P.NON_FINITE}: ',
        CASE WHEN isnan(__value) THEN 'nan' WHEN __value > 0 THEN 'inf' ELSE '-inf' END)
    WHEN 'BAD_TIMESTAMP' THEN
        concat('{P.BAD_TIMESTAMP}: ', {P.quoted('__time_field', '__fields.timestamp')}) END"""

_TAGS = P.tags_of("__raw", "CASE WHEN __usual THEN __row.tags ELSE __fields.tags END")

# One projection per step, so that nothing costly is worked out twice.
_STEPS = [
    {"__first": P.parse_usual("__raw")},
    {"__row": P.single_object("__first", "__raw")},
    {"__row_time": P.usual_timestamp("__row.timestamp")},
    {"__usual": P.is_usual("__row", "__row_time")},
    {"__parsed": f"CASE WHEN NOT __usual THEN {P.parse_wrapped('__raw')} END"},
    {"__fields": P.single_object("__parsed", "__raw")},
    {
        "__missing": P.missing_fields("__fields"),
        "__number_field": P.scalar("__fields.value"),
        "__time_field": P.scalar("__fields.timestamp"),
    },
    {
        "__value": f"CASE WHEN __usual THEN __row.value "
        f"ELSE {P.rarely('__number_field', P.as_number)} END",
        "__time": f"CASE WHEN __usual THEN __row_time "
        f"ELSE {P.rarely('__time_field', P.as_timestamp)} END",
    },
]
_CHECKED = ["__usual", "__row", "__fields", "__missing", "__number_field", "__time_field"]
_CHECKED += ["__value", "__time"]


def parse(df: DataFrame, raw: str = "raw", received_at: Column | None = None) -> DataFrame:
    """Add the record columns, ``reason``, ``reason_code`` and ``received_at``.

    ``reason`` is NULL on valid rows. The checks run in a fixed order and the first one
    that fails names the reason: JSON, object, required fields, number, finite, time.
    All other columns (such as Kafka coordinates) are kept. ``received_at`` defaults to a
    Kafka ``timestamp`` column, else to the current time.
    """
    if received_at is None:
        received_at = F.col("timestamp") if "timestamp" in df.columns else F.current_timestamp()
    kept = [c for c in df.columns if c not in (raw, "timestamp", "value", "received_at")]
    step = df.select(*kept, F.col(raw).alias("__raw"), received_at.alias("received_at"))
    for columns in _STEPS:
        step = step.selectExpr("*", *[f"{sql} AS {name}" for name, sql in columns.items()])
    # A one-element explode: filters on the outcome stay above it, so the optimizer does
    # not copy the JSON parse into them.
    fields = ", ".join(f"'{name}', {name}" for name in _CHECKED)
    checked = f"explode(array(named_struct({fields}, 'reason_code', {_CODE}))) AS __checked"
    names = [f"`{c}`" for c in kept]
    step = step.selectExpr(*names, "__raw", "received_at", checked)
    step = step.selectExpr(*names, "__raw", "received_at", "__checked.*")

    def text_of(name: str) -> str:
        exact = P.rarely(f"__fields.{name}", P.as_text)
        return f"CASE WHEN __usual THEN __row.{name} ELSE {exact} END"

    outputs = {
        name: text_of(name) for name in ("message_id", "sensor_id", "metric_name", "unit")
    } | {
        "value": "__value",
        "timestamp": "__time",
        "tags": _TAGS,
    }
    step = step.selectExpr(
        *names,
        "__raw AS raw",
        "received_at",
        f"{_REASON} AS reason",
        "reason_code",
        *[
            f"CASE WHEN reason_code IS NULL THEN {sql} END AS {name}"
            for name, sql in outputs.items()
        ],
    )
    return step.selectExpr("*", "try_variant_get(tags, '$', 'map<string,string>') AS tags_map")


def valid_records(parsed: DataFrame) -> DataFrame:
    """Rows that passed every check, without the failure columns."""
    return parsed.filter(F.col("reason_code").isNull()).drop("raw", "reason", "reason_code")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Rows that failed, with the payload cut to its first characters."""
    coordinates = [c for c in ("topic", "partition", "offset") if c in parsed.columns]
    return parsed.filter(F.col("reason_code").isNotNull()).select(
        F.substring("raw", 1, P.PAYLOAD_CHARS).alias("raw_payload"),
        "reason",
        "reason_code",
        "received_at",
        *coordinates,
    )
