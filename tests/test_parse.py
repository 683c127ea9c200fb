import pytest
from datetime import datetime

from pyspark.sql import functions as F

from tidegauge.functions.text import age_seconds
from tidegauge.operators.parse import dead_letters, parse, valid_records
from tidegauge.sources.readers import from_kafka


def message(value="12.5", time='"2024-01-01T00:00:00"', mid='"m"', tags='{"plant":"A7"}', more=""):
    return (
        f'{{"message_id":{mid},"sensor_id":"s","metric_name":"p","value":{value},'
        f'"unit":"bar","timestamp":{time},"tags":{tags}{more}}}'
    )


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    return parse(df).orderBy("i")


INVALID = [
    ("not json {{{", "JSON_PARSE"),
    ("this is not json at all }{", "JSON_PARSE"),
    ("", "JSON_PARSE"),
    (None, "JSON_PARSE"),
    (message() + " x", "JSON_PARSE"),
    (message() + "}", "JSON_PARSE"),
    (message() + "]", "JSON_PARSE"),
    (message() + "],[" + message(), "JSON_PARSE"),
    (message() + "," + message(), "JSON_PARSE"),
    ("/*c*/" + message(), "JSON_PARSE"),
    ("{'message_id':1}", "JSON_PARSE"),
    (message(value="01"), "JSON_PARSE"),
    (message(value="+1"), "JSON_PARSE"),
    ("[1]", "NOT_OBJECT"),
    ("5", "NOT_OBJECT"),
    ("null", "NOT_OBJECT"),
    ('"s"', "NOT_OBJECT"),
    ("NaN", "NOT_OBJECT"),
    ("{}", "MISSING_FIELDS"),
    ('{"sensor_id": "s1"}', "MISSING_FIELDS"),
    ('{"sensor_id": "PUMP_A7_INLET", "value": "COMM_ERROR"}', "MISSING_FIELDS"),
    (message(value='"oops"'), "NON_NUMERIC"),
    (message(value="null", time='"bad"'), "NON_NUMERIC"),
    (message(value='"12d"'), "NON_NUMERIC"),
    (message(value='"0x1f"'), "NON_NUMERIC"),
    (message(value='"1__0"'), "NON_NUMERIC"),
    (message(value="[1]"), "NON_NUMERIC"),
    (message(value='{"a":1}'), "NON_NUMERIC"),
    (message(value="NaN"), "NON_FINITE"),
    (message(value="-Infinity"), "NON_FINITE"),
    (message(value='"nan"'), "NON_FINITE"),
    (message(value='"-inf"'), "NON_FINITE"),
    (message(value="1e400"), "NON_FINITE"),
    (message(value="1" + "0" * 400), "NON_FINITE"),
    (message(value="999999", time='"not-a-date"'), "BAD_TIMESTAMP"),
    (message(time='"1700000000"'), "BAD_TIMESTAMP"),
    (message(time='"2024-13-01"'), "BAD_TIMESTAMP"),
    (message(time='"2024-1-1"'), "BAD_TIMESTAMP"),
    (message(time='"2021-W53-1"'), "BAD_TIMESTAMP"),
    (message(time='" 2024-01-01"'), "BAD_TIMESTAMP"),
    (message(time="null"), "BAD_TIMESTAMP"),
    (message(time="1e20"), "BAD_TIMESTAMP"),
    (message(time="{}"), "BAD_TIMESTAMP"),
]

VALUES = [
    ("12.5", 12.5),
    ('"12.5"', 12.5),
    ('" 7 "', 7.0),
    ('"1_000.5"', 1000.5),
    ('".5e1"', 5.0),
    ("true", 1.0),
    ("false", 0.0),
    ("-3", -3.0),
    ("1.0e2", 100.0),
    ("123456789012345678901234567890", 1.2345678901234568e29),
]

TIMES = [
    ('"2024-01-01T10:11:12"', "2024-01-01 10:11:12"),
    ('"2024-01-01 10:11:12.5"', "2024-01-01 10:11:12.5"),
    ('"2024-01-01T10:11:12.123456789"', "2024-01-01 10:11:12.123456"),
    ('"2024-01-01T10:11:12Z"', "2024-01-01 10:11:12"),
    ('"2024-01-01T00:00:00.5+05:30"', "2023-12-31 18:30:00.5"),
    ('"2024-01-01T00:00:00-0130"', "2024-01-01 01:30:00"),
    ('"2024-01-01T00:00:00+00:00:30"', "2023-12-31 23:59:30"),
    ('"2024-01-01"', "2024-01-01 00:00:00"),
    ('"2024-01-01T10"', "2024-01-01 10:00:00"),
    ('"20240101T101112,25"', "2024-01-01 10:11:12.25"),
    ('"2024-W01-1"', "2024-01-01 00:00:00"),
    ('"2020W537"', "2021-01-03 00:00:00"),
    ("1700000000.25", "2023-11-14 22:13:20.25"),
    ("1700000000", "2023-11-14 22:13:20"),
    ("-1.5", "1969-12-31 23:59:58.5"),
    ("true", "1970-01-01 00:00:01"),
]

IDS = [
    ('"m"', "m"),
    ("5", "5"),
    ("5.0", "5.0"),
    ("5.25", "5.25"),
    ("true", "True"),
    ('"true"', "true"),
    ("null", "None"),
    ("12345678901234567890", "12345678901234567890"),
    ('"12.50"', "12.50"),
    ('"[x"', "[x"),
]


def test_first_failing_check_names_the_reason(spark):
    got = [r["reason_code"] for r in parsed(spark, [t for t, _ in INVALID]).collect()]
    assert got == [code for _, code in INVALID]


def test_reason_texts(spark):
    texts = ["{", "[1]", '{"sensor_id":"s","unit":"u"}', message('"oops"'), message("null"),
             message('"nan"'), message(time='"not-a-date"')]
    got = [r["reason"] for r in parsed(spark, texts).collect()]
    assert got[0].startswith("JSON parse error")
    assert got[1:] == [
        "Payload is not a JSON object",
        "Missing fields: {'message_id', 'metric_name', 'timestamp', 'value'}",
        "Non-numeric value: 'oops'",
        "Non-numeric value: None",
        "Non-finite value: nan",
        "Unparseable timestamp: 'not-a-date'",
    ]


def test_values(spark):
    got = parsed(spark, [message(value=v) for v, _ in VALUES]).collect()
    assert [r["value"] for r in got] == [v for _, v in VALUES]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = parsed(spark, [message(time=t) for t, _ in TIMES])
        got = [r[0] for r in rows.select(F.unix_micros("timestamp")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = [
        (datetime.fromisoformat(w) - datetime(1970, 1, 1)) // (datetime.resolution) for _, w in TIMES
    ]
    assert got == want


def test_ids_as_text(spark):
    got = parsed(spark, [message(mid=m) for m, _ in IDS]).collect()
    assert [r["message_id"] for r in got] == [m for _, m in IDS]


def test_last_of_repeated_keys_wins(spark):
    got = parsed(spark, [message(more=',"value":2'), message(tags='{"a":1,"a":2}')]).collect()
    assert got[0]["value"] == 2.0
    assert got[1]["tags_map"] == {"a": "2"}


def test_tags(spark):
    without = message().replace(',"tags":{"plant":"A7"}', "")
    rows = parsed(spark, [message(), without, message(tags="[1,2]")])
    got = rows.select("tags_map", F.col("tags").cast("string").alias("t")).collect()
    assert got[0]["tags_map"] == {"plant": "A7"}
    assert got[1]["tags_map"] == {} and got[1]["t"] == "{}"
    assert got[2]["tags_map"] is None and got[2]["t"] == "[1,2]"


def test_dead_letters_cut_the_payload_and_keep_coordinates(spark):
    df = spark.createDataFrame([("x" * 600, "t", 3, 9)], "raw string, topic string, partition int, offset bigint")
    row = dead_letters(parse(df)).first()
    assert len(row["raw_payload"]) == 500
    assert (row["topic"], row["partition"], row["offset"]) == ("t", 3, 9)
    assert row["received_at"] is not None


def test_kafka_bytes(spark):
    good = message().encode()
    bad = message(mid='"\xff"').encode("latin-1")
    df = spark.createDataFrame(
        [(good, "t", 0, 1, datetime(2024, 1, 1)), (bad, "t", 0, 2, datetime(2024, 1, 1)), (None, "t", 0, 3, datetime(2024, 1, 1))],
        "value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    rows = {r["offset"]: r for r in parse(from_kafka(df)).collect()}
    assert rows[1]["reason_code"] is None and rows[1]["message_id"] == "m"
    assert rows[2]["message_id"] == "�"
    assert rows[3]["reason_code"] == "JSON_PARSE"
    assert rows[1]["received_at"] == datetime(2024, 1, 1)


def test_filter_on_the_outcome_does_not_repeat_the_parse(spark):
    df = spark.createDataFrame([(message(),)], "raw string")
    plan = valid_records(parse(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("value,DoubleType") <= 2  # one parse, named once or twice on its line


def test_age(spark):
    now = F.lit("2024-01-01 00:01:00").cast("timestamp")
    row = parsed(spark, [message()]).select(age_seconds(F.col("timestamp"), now)).first()
    assert row[0] == 60.0
