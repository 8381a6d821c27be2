import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.contracts import RuleBounds
from tidewatch.functions.parse import decode_records, parse_events
from tidewatch.functions.rules import (
    all_failures,
    first_failure,
    split_reason,
    strict_failures,
)
from tidewatch.operators.routing import REASON, split_events, tag_events

def now():
    return F.lit("2026-06-25 15:00:00").cast("timestamp")

# What to break, the first reason, and every reason's code.
CASES = [
    ({}, None, []),
    ({"price": -1.0}, "invalid_price: price <= min", ["invalid_price"]),
    ({"price": 0.0}, "invalid_price: price <= min", ["invalid_price"]),
    ({"price": 1_000_000.0}, None, []),
    ({"price": 1_000_000.5}, "invalid_price: price > max", ["invalid_price"]),
    ({"volume": ...}, "missing_or_null: volume", ["missing_field"]),
    ({"volume": -1}, "invalid_volume: volume < min", ["invalid_volume"]),
    ({"volume": 0}, None, []),
    ({"volume": 1.0}, "missing_or_null: volume", ["wrong_type"]),
    ({"volume": True}, "missing_or_null: volume", ["wrong_type"]),
    ({"symbol": None}, "missing_or_null: symbol", ["null_value"]),
    ({"event_id": None}, "missing_or_null: event_id", ["null_value"]),
    ({"price": "expensive"}, "missing_or_null: price", ["wrong_type"]),
    ({"price": True}, "missing_or_null: price", ["wrong_type"]),
    ({"change": "up"}, None, ["wrong_type"]),
    ({"change_percent": 5000.0}, "invalid_change_percent: out of range",
     ["invalid_change_percent"]),
    ({"change_percent": -100.0}, None, []),
    ({"change_percent": None}, None, []),
    ({"timestamp": "2026-99-99T99:99:99"}, "missing_or_null: timestamp", ["invalid_timestamp"]),
    ({"timestamp": 17}, "missing_or_null: timestamp", ["invalid_timestamp"]),
    ({"timestamp": "2026-06-25T16:00:00Z"}, None, ["future_timestamp"]),
    ({"timestamp": "2026-06-25T15:05:00Z"}, None, []),
    ({"exchange": "MARS"}, "invalid_exchange: not allowed", ["invalid_exchange"]),
    ({"exchange": ["NYSE"]}, "invalid_exchange: not allowed", ["invalid_exchange"]),
    ({"exchange": None}, None, []),
    ({"price": -1.0, "exchange": "MARS"}, "invalid_price: price <= min",
     ["invalid_price", "invalid_exchange"]),
    ({"event_id": ..., "symbol": ..., "price": ...},
     "corrupted_json: payload was not parseable", ["missing_field"] * 3),
]


@pytest.fixture(scope="module")
def judged(bus, event):
    records = bus(*[event(**changes) for changes, _, _ in CASES])
    first = tag_events(parse_events(records)).select("kafka_offset", REASON)
    every = all_failures(decode_records(records), now())
    rows = every.join(first, "kafka_offset").orderBy("kafka_offset").collect()
    return {r.kafka_offset: r for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(judged, i):
    _, first, codes = CASES[i]
    assert judged[i][REASON] == first
    assert judged[i].reason_codes == codes
    assert judged[i].is_valid == (not codes)


def test_texts_quote_the_values(bus, event):
    rows = all_failures(
        decode_records(
            bus(
                event(price=-1.5, exchange="MARS"), event(volume=..., symbol=None),
                event(price="expensive"), event(change_percent=5000.0), event(volume=2.5),
                event(timestamp="2026-06-25T16:00:00Z"), event(timestamp="soon"),
            )
        ),
        now(),
    ).orderBy("kafka_offset").collect()
    assert [r.error_reason for r in rows] == [
        "invalid_price: -1.5 <= min 0.0; invalid_exchange: 'MARS' not in "
        "['AMEX', 'BSE', 'NASDAQ', 'NSE', 'NYSE']",
        "null_value: 'symbol' is null; missing_field: 'volume' is absent",
        "wrong_type: 'price' must be numeric, got str ('expensive')",
        "invalid_change_percent: 5000.0 outside [-100.0, 1000.0]",
        "wrong_type: 'volume' must be integer, got float",
        "future_timestamp: '2026-06-25T16:00:00Z' is 3600s ahead of now (max 300s)",
        "invalid_timestamp: 'soon' is not valid ISO-8601",
    ]


@pytest.mark.parametrize(
    "text,reason",
    [
        ("{not valid json", "corrupted_json: payload was not parseable"),
        ("[1]", "wrong_root_type: expected object, got list"),
        ('"x"', "wrong_root_type: expected object, got str"),
        ("17", "wrong_root_type: expected object, got int"),
        (" null ", "wrong_root_type: expected object, got NoneType"),
    ],
)
def test_no_object(bus, text, reason):
    assert all_failures(decode_records(bus(text)), now()).first().error_reason == reason


def test_negative_zero_keeps_its_sign(bus, event):
    rows = all_failures(
        decode_records(bus(event(price=-0.0), event(price=0.0), event(price=0))), now()
    ).orderBy("kafka_offset").collect()
    assert [r.error_reason for r in rows] == [
        f"invalid_price: {price} <= min 0.0" for price in ("-0.0", "0.0", "0")
    ]


def test_empty_object_misses_every_required_field(bus):
    row = all_failures(decode_records(bus(" {}")), now()).first()
    assert row.reason_codes == ["missing_field"] * 5


def test_timestamp_first_names_the_better_reason(bus, event):
    parsed = parse_events(bus(event(timestamp="soon")))
    assert tag_events(parsed, timestamp_first=True).first()[REASON] == (
        "invalid_timestamp: not ISO-8601"
    )


def test_nan_price_ranks_above_the_maximum(bus, event):
    row = tag_events(parse_events(bus(event(price=math.nan)))).first()
    assert row[REASON] == "invalid_price: price > max"


def test_bounds_are_parameters(bus, event):
    bounds = RuleBounds(price_max=50.0, exchanges=("LSE",))
    assert tag_events(parse_events(bus(event())), bounds).first()[REASON] == (
        "invalid_price: price > max"
    )
    assert all_failures(decode_records(bus(event())), now(), bounds).first().reason_codes == [
        "invalid_price", "invalid_exchange",
    ]


def test_rule_expression_grows_linearly(spark):
    def size(bounds):
        return len(str(first_failure(bounds)._jc.toString()))

    few, more, most = (
        size(RuleBounds(required=("event_id",) * n)) for n in (5, 10, 20)
    )
    assert (most - more) == pytest.approx(2 * (more - few), rel=0.1)


@pytest.mark.parametrize(
    "changes,errors",
    [
        ({}, []),
        ({"company": ...}, ["required: company"]),
        ({"extra": 1}, ["additional_properties"]),
        ({"symbol": "ABCDEFGHIJKLM"}, ["max_length: symbol"]),
        ({"event_id": ""}, ["min_length: event_id"]),
        ({"price": 0}, ["minimum: price"]),
        ({"volume": -1}, ["minimum: volume"]),
        ({"volume": 1.5}, ["type: volume"]),
        ({"volume": 2.0}, []),
        ({"change": None}, ["type: change"]),
        ({"timestamp": 5}, ["type: timestamp"]),
    ],
)
def test_strict_contract(bus, event, changes, errors):
    row = strict_failures(decode_records(bus(event(**changes)))).first()
    assert row.contract_errors == errors


def test_strict_contract_on_no_object(bus):
    rows = strict_failures(decode_records(bus("{x", "[1]"))).orderBy("kafka_offset").collect()
    assert [r.contract_errors for r in rows] == [["not_json"], ["type: root"]]


def test_split_reason(spark):
    df = spark.createDataFrame(
        [("producer_validation_failed: null_value: 'symbol' is null",),
         ("kafka_delivery_failed: timed out",), ("invalid_price: price <= min",)],
        "r string",
    )
    rows = [tuple(r.s) for r in df.select(split_reason(F.col("r")).alias("s")).collect()]
    assert rows[0] == ("producer_validation_failed", "null_value", "'symbol' is null")
    assert rows[1][0] == "kafka_delivery_failed"
    assert rows[2] == ("stream_validation", "invalid_price", "price <= min")


_FIELD_VALUES = st.one_of(
    st.none(), st.booleans(), st.integers(-5, 2_000_000),
    st.floats(-200, 2e6, allow_nan=False).map(lambda x: round(x, 4)),
    st.sampled_from(["AAPL", "NYSE", "MARS", "", "2026-06-25T14:30:00Z", "soon"]),
)
_SHARED = {"invalid_price", "invalid_volume", "invalid_change_percent", "invalid_exchange"}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(
    st.sampled_from(["event_id", "symbol", "price", "volume", "change_percent", "timestamp",
                     "exchange"]), _FIELD_VALUES), min_size=1, max_size=30))
def test_both_readings_agree(bus, event, changes):
    """The first failure, where both readings know the rule, is among all failures."""
    records = bus(*[json.dumps(event(**c)) for c in changes])
    tagged = tag_events(parse_events(records))
    valid, invalid = split_events(tagged)
    assert valid.count() + invalid.count() == len(changes)
    every = all_failures(decode_records(records), now()).select("kafka_offset", "reason_codes")
    for row in tagged.join(every, "kafka_offset").collect():
        code = (row[REASON] or "").split(":")[0]
        if code in _SHARED:
            assert code in row.reason_codes
        if not row.reason_codes:
            assert row[REASON] is None
