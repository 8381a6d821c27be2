import pytest
from pyspark.sql import functions as F

from tidewatch.functions.enrich import enrich_events, price_band
from tidewatch.functions.parse import event_json, iso_timestamp, parse_events


def test_parses_with_fixed_schema(bus, event):
    row = parse_events(bus(event())).first()
    assert (row.symbol, row.price, row.volume) == ("AAPL", 64.25, 8200)
    assert row.event_ts is not None and row.raw_value.startswith("{")
    assert (row.kafka_topic, row.kafka_partition, row.kafka_offset) == ("events", 0, 0)


@pytest.mark.parametrize("text", ["{not valid json", "", "null", "[]", "{}", "17"])
def test_unreadable_payload_leaves_nulls(bus, text):
    row = parse_events(bus(text)).first()
    assert row.event_id is None and row.price is None and row.event_ts is None
    assert row.raw_value == text


@pytest.mark.parametrize(
    "given,field,expected",
    [
        ('{"price":"12.5","symbol":"A"}', "price", None),
        ('{"price":true,"symbol":"A"}', "price", None),
        ('{"volume":10.5,"symbol":"A"}', "volume", None),
        ('{"volume":3.0,"symbol":"A"}', "volume", None),
        ('{"symbol":12}', "symbol", "12"),
        ('{"symbol":"A","symbol":"B"}', "symbol", "B"),
        ('{"symbol":"A","other":1}', "symbol", "A"),
    ],
)
def test_field_corner_cases(bus, given, field, expected):
    assert parse_events(bus(given)).first()[field] == expected


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2026-06-25T14:30:00Z", True),
        ("2026-06-25T14:30:00.123456Z", True),
        ("2026-06-25T14:30:00+02:00", True),
        ("2026-06-25 14:30:00", True),
        ("2026-06-25", True),
        ("2026-99-99T99:99:99", False),
        ("not-a-date", False),
        ("2026", False),
        ("12:00", False),
        ("", False),
        (None, False),
    ],
)
def test_iso_timestamp(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert (df.select(iso_timestamp(F.col("t")).alias("x")).first().x is not None) is ok


def test_zone_is_respected(spark):
    df = spark.createDataFrame([("2026-06-25T01:00:00+02:00",), ("2026-06-24T23:00:00",)], "t string")
    shown = df.select(iso_timestamp(F.col("t")).cast("string").alias("x")).collect()
    assert [r.x for r in shown] == ["2026-06-24 23:00:00"] * 2


def test_date_parts_and_band(bus, event):
    row = enrich_events(parse_events(bus(event()))).first()
    assert (row.event_year, row.event_month, row.event_day, row.event_hour) == (2026, 6, 25, 14)
    assert str(row.event_date) == "2026-06-25" and row.price_bucket == "50-100"


@pytest.mark.parametrize(
    "price,band",
    [
        (0.0, "0-50"), (25.0, "0-50"), (49.99, "0-50"), (50.0, "50-100"), (75.0, "50-100"),
        (100.0, "100-250"), (187.4, "100-250"), (250.0, "250-500"), (300.0, "250-500"),
        (500.0, "500-1000"), (1000.0, "1000+"), (1500.0, "1000+"), (-1.0, "unknown"),
        (None, "unknown"), (float("nan"), "1000+"),
    ],
)
def test_price_band(spark, price, band):
    df = spark.createDataFrame([(price,)], "p double")
    assert df.select(price_band(F.col("p")).alias("b")).first().b == band


def test_event_json_keeps_field_order_and_nulls(bus, event):
    import json

    given = event(company=None)
    text = parse_events(bus(given)).select(event_json().alias("j")).first().j
    assert json.loads(text) == given and list(json.loads(text)) == list(given)


def test_json_is_parsed_once_per_row(bus, event, spark):
    """A filter on parsed fields must not drag copies of the parser below itself."""
    from tidewatch.operators.routing import split_events, tag_events

    valid, _ = split_events(tag_events(parse_events(bus(event()))))
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
