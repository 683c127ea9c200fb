"""SQL expressions that validate one JSON text; no Python runs per row.

Each function takes SQL operands (column names, or a lambda variable) and gives SQL text, so
a whole validation reaches the JVM as a few strings.

A reading in the usual shape (texts, a number, an ISO time) costs one typed JSON parse.
Every other row is parsed again with its JSON types kept; those checks sit behind ``CASE``
branches, so usual rows do not pay for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six required names, the reason texts and the payload cut.
REQUIRED = ["message_id", "sensor_id", "metric_name", "value", "unit", "timestamp"]
PAYLOAD_CHARS = 500
JSON_PARSE = "JSON parse error"
NOT_OBJECT = "Payload is not a JSON object"
MISSING_FIELDS = "Missing fields"
NON_NUMERIC = "Non-numeric value"
NON_FINITE = "Non-finite value"
BAD_TIMESTAMP = "Unparseable timestamp"

_STRICT = "map('allowSingleQuotes', 'false')"
_FIELDS = ", ".join(f"{name} variant" for name in REQUIRED)
_USUAL_FIELDS = (
    "message_id string, sensor_id string, metric_name string, value double, unit string, "
    "timestamp string, tags variant"
)

# Text accepted as a float: sign, digits with single underscores, exponent, or a name.
_DIGITS = "[0-9](_?[0-9])*"
_NUMBER_TEXT = f"^[+-]?({_DIGITS}([.]({_DIGITS})?)?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?$"
_INFINITY_TEXT = "^(?i)[+-]?inf(inity)?$"
_NAN_TEXT = "^(?i)[+-]?nan$"

# The common ISO form goes straight to the built-in reader; the other accepted forms
# (basic format, comma fractions, hour-only times, odd offsets) are respelled first.
_ISO_COMMON = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([.]\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"
_ISO_ANY = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
    r"(?:([+-]\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,]\d+)?)?)?)?)?$"
)
_ISO_PARTS = "$1-$2$4-$3$5 $6:$7:$8.$9|$10:$11:$12"
_EMPTY_PART = "(?<=[ :|])(?=[:.|]|$)"
_ISO_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?$"

# A whole number of up to 18 digits is a BIGINT, so a DECIMAL of that size had a point.
_POINTED = r"^DECIMAL\((\d+,[1-9]\d*|\d,0|1[0-8],0)\)$"
# Texts that may have been JSON booleans, containers or non-integer numbers.
_RESPELLED = r"(?m)^(true|false|[\[{]|-?[0-9]+[.eE])"

_EPOCH_MIN = -62135596800  # 0001-01-01
_EPOCH_MAX = 253402300800  # 10000-01-01
_DAY_MICROS = 86_400_000_000


def decode_utf8(value: Column) -> Column:
    """Bytes to text; undecodable bytes become U+FFFD."""
    return F.make_valid_utf8(value.cast("binary").cast("string"))


def _as_array(raw: str, schema: str) -> str:
    """Parsed as the only element of an array, which rejects trailing text."""
    return f"from_json(concat('[', {raw}, ']'), '{schema}', {_STRICT})"


def _as_field(raw: str) -> str:
    """Whether the text also holds as a field of an object."""
    return f"""(from_json(concat('{{"x":', {raw}, '}}'), 'map<string,string>', {_STRICT}) IS NOT NULL)"""


def parse_usual(raw: str) -> str:
    """With the usual types; fields of another type come back NULL."""
    return _as_array(raw, f"array<struct<{_USUAL_FIELDS}>>")


def parse_wrapped(raw: str) -> str:
    """With the JSON types of the fields kept."""
    return _as_array(raw, f"array<struct<{_FIELDS}, tags variant>>")


def single_object(parsed: str, raw: str) -> str:
    """The one object of such an array, else NULL.

    Only a text holding ``]`` could end the wrapper early, so only those take a second
    check.
    """
    closed = f"CASE WHEN instr({raw}, ']') = 0 THEN true ELSE {_as_field(raw)} END"
    return f"CASE WHEN size({parsed}) = 1 AND {closed} THEN get({parsed}, 0) END"


def is_json(raw: str) -> str:
    """Whether the text is JSON of any kind; evaluated on failing rows only."""
    one = f"size({_as_array(raw, 'array<string>')}) = 1"
    return f"coalesce({one} AND {_as_field(raw)} AND length(trim({raw})) > 0, false)"


def is_usual(row: str, time: str) -> str:
    """Whether the usual-type parse gives the exact outcome."""
    texts = [f"{row}.{name}" for name in ("message_id", "sensor_id", "metric_name", "unit")]
    present = " AND ".join(f"{x} IS NOT NULL" for x in [f"{row}.value", time, *texts])
    spelled = f"concat_ws('\\n', {', '.join(texts)}) RLIKE r'{_RESPELLED}'"
    return f"coalesce({present} AND {is_finite(f'{row}.value')} AND NOT {spelled}, false)"


def missing_fields(fields: str) -> str:
    """Quoted, sorted names of the absent required fields (a JSON null is present)."""
    names = ", ".join(
        f"""CASE WHEN {fields}.{name} IS NULL THEN "'{name}'" END""" for name in sorted(REQUIRED)
    )
    return f"concat_ws(', ', {names})"


def tags_of(raw: str, tags: str) -> str:
    """The tags, by default an empty object.

    Tags with a repeated key are not a variant; those are read as a map, the last one wins.
    """
    pairs = f"from_json({raw}, 'tags map<string,string>').tags"
    keys = f"array_distinct(map_keys({pairs}))"
    last = f"element_at(filter(map_entries({pairs}), e -> e.key = k), -1).value"
    repeated = f"to_variant_object(map_from_arrays({keys}, transform({keys}, k -> {last})))"
    return f"""coalesce({tags}, CASE WHEN instr({raw}, '"tags"') > 0 THEN {repeated} END,
        parse_json('{{}}'))"""


def rarely(value: str, sql: Callable[[str], str]) -> str:
    """``sql(value)`` as a lambda, which keeps the code of rare branches out of the generated
    method of the stage; a large method is not compiled and slows every row."""
    return f"get(transform(array({value}), x -> {sql('x')}), 0)"


def scalar(value: str) -> str:
    """A JSON field as struct (kind, text, number), so that each is worked out once."""
    return f"""named_struct('kind', schema_of_variant({value}),
        'text', try_variant_get({value}, '$', 'string'),
        'number', try_variant_get({value}, '$', 'double'))"""


def _is_number(kind: str) -> str:
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'BOOLEAN') OR {kind} LIKE 'DECIMAL%')"


def as_text(value: str) -> str:
    """A JSON scalar as text: null is None, booleans are capitalised, floats keep a point."""
    text = f"try_variant_get({value}, '$', 'string')"
    return f"""CASE schema_of_variant({value}) WHEN 'STRING' THEN {text} WHEN 'VOID' THEN 'None'
        WHEN 'BOOLEAN' THEN initcap({text})
        ELSE CASE WHEN schema_of_variant({value}) RLIKE r'{_POINTED}'
            THEN CAST(try_variant_get({value}, '$', 'double') AS STRING) ELSE {text} END END"""


def number_text(text: str) -> str:
    """A text as a float, NULL where it is not one (so ``12d`` and hex are not)."""
    trimmed = f"regexp_replace({text}, r'^\\s+|\\s+$', '')"
    return f"""CASE WHEN {trimmed} RLIKE r'{_NUMBER_TEXT}'
            THEN try_cast(replace({trimmed}, '_', '') AS DOUBLE)
        WHEN {trimmed} RLIKE r'{_NAN_TEXT}' THEN double('NaN')
        WHEN {trimmed} RLIKE r'{_INFINITY_TEXT}'
            THEN CASE WHEN {trimmed} LIKE '-%' THEN double('-Infinity') ELSE double('Infinity') END
        END"""


def as_number(field: str) -> str:
    """A ``scalar`` as DOUBLE: numbers, numeric texts and booleans; else NULL."""
    return f"""CASE WHEN {_is_number(f'{field}.kind')} THEN {field}.number
        WHEN {field}.kind = 'STRING' THEN {number_text(f'{field}.text')} END"""


def is_finite(number: str) -> str:
    return f"(NOT isnan({number}) AND abs({number}) < double('Infinity'))"


def epoch_timestamp(seconds: str) -> str:
    """Epoch seconds (years 1 to 9999) to a UTC timestamp, else NULL."""
    return f"""CASE WHEN {seconds} >= {_EPOCH_MIN} AND {seconds} < {_EPOCH_MAX}
            AND NOT isnan({seconds})
        THEN timestamp_micros(floor({seconds}) * 1000000L
            + CAST(rint(({seconds} - floor({seconds})) * 1e6) AS BIGINT)) END"""


def _first_monday(year: str) -> str:
    """Day number (from 1970-01-01) of the Monday of ISO week 1, the week of January 4."""
    fourth = f"unix_date(make_date({year}, 1, 4))"
    # 1970-01-01 was a Thursday, so day number + 3 counts weeks from a Monday.
    return f"({fourth} - pmod({fourth} + 3, 7))"


def _week_timestamp(text: str) -> str:
    year, week, day = (
        f"try_cast(regexp_extract({text}, r'{_ISO_WEEK}', {i}) AS INT)" for i in (1, 2, 3)
    )
    monday = f"({_first_monday(year)} + ({week} - 1) * 7)"
    return f"""CASE WHEN {text} RLIKE r'{_ISO_WEEK}' AND {week} >= 1
            AND {monday} < {_first_monday(f'({year} + 1)')}
        THEN timestamp_micros(CAST({monday} + coalesce({day}, 1) - 1 AS BIGINT) * {_DAY_MICROS}L)
        END"""


def _respelled_timestamp(text: str) -> str:
    """Any accepted calendar form: spelled as ``date time.fraction|offset``, empty parts 00."""
    zulu = f"replace({text}, 'Z', '+00:00')"
    parts = f"""regexp_replace(regexp_replace({zulu}, r'{_ISO_ANY}', '{_ISO_PARTS}'),
        r'{_EMPTY_PART}', '00')"""
    local = f"try_to_timestamp(concat(substring_index({parts}, '|', 1), 'Z'))"
    offset_text = f"substring_index({parts}, '|', -1)"
    offset = f"""unix_micros(try_to_timestamp(
        concat('1970-01-01 ', regexp_replace({offset_text}, '^[+-]', ''), 'Z')))"""
    sign = f"CASE WHEN {offset_text} LIKE '-%' THEN -1 ELSE 1 END"
    return f"""CASE WHEN {zulu} RLIKE r'{_ISO_ANY}'
        THEN timestamp_micros(unix_micros({local}) - {sign} * {offset}) END"""


def _zoned_timestamp(text: str) -> str:
    has_offset = f"({text} LIKE '%Z' OR substring({text}, -6, 1) IN ('+', '-'))"
    return f"try_to_timestamp(CASE WHEN {has_offset} THEN {text} ELSE concat({text}, 'Z') END)"


def usual_timestamp(text: str) -> str:
    return f"CASE WHEN {text} RLIKE r'{_ISO_COMMON}' THEN {_zoned_timestamp(text)} END"


def iso_timestamp(text: str) -> str:
    """ISO-8601 text to a UTC timestamp; text without an offset is UTC; else NULL.

    Independent of the session time zone.
    """
    return f"""CASE WHEN {text} RLIKE r'{_ISO_COMMON}' THEN {_zoned_timestamp(text)}
        ELSE coalesce({_respelled_timestamp(text)}, {_week_timestamp(text)}) END"""


def as_timestamp(field: str) -> str:
    """A ``scalar`` as a timestamp: numbers are epoch seconds, texts are ISO-8601."""
    return f"""CASE WHEN {field}.kind = 'STRING' THEN {iso_timestamp(f'{field}.text')}
        WHEN {_is_number(f'{field}.kind')} THEN {epoch_timestamp(f'{field}.number')} END"""


def quoted(field: str, value: str) -> str:
    """A field for a reason text: strings in single quotes."""
    return f"""CASE WHEN {field}.kind = 'STRING' THEN concat("'", {field}.text, "'")
        ELSE {as_text(value)} END"""
