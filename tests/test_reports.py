import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewatch.contracts import (
    AGGREGATE_SCHEMA,
    DEAD_LETTER_SCHEMA,
    METRICS_SCHEMA,
    RAW_EVENT_SCHEMA,
    AlertThresholds,
)
from tidewatch.functions.parse import decode_records
from tidewatch.functions.scores import grade, rate_pct, rounded_mean, score_pct
from tidewatch.plans import alerts, quality, views

DAY = dt.date(2026, 6, 25)


def now():
    return F.lit("2026-06-25 15:00:00").cast("timestamp")


def when(hour, minute=0, day=25):
    return dt.datetime(2026, 6, day, hour, minute)


@pytest.fixture(scope="module")
def raw(spark):
    def row(event_id, symbol, price, volume, ts, exchange="NYSE"):
        return (event_id, symbol, f"{symbol} Inc.", price, volume, 0.0, 0.0, ts, exchange,
                ts.date(), ts.hour, ts.day, ts.month, ts.year, "0-50", ts)

    return spark.createDataFrame(
        [
            row("1", "A", 10.0, 100, when(9)),
            row("2", "A", 12.0, 200, when(10)),
            row("3", "A", 11.0, 50, when(10)),
            row("4", "B", 20.0, 70, when(10, day=22), None),
            row("5", "C", 30.0, 500, when(23, day=24), "AMEX"),
        ],
        RAW_EVENT_SCHEMA,
    )


@pytest.fixture(scope="module")
def letters(spark):
    return spark.createDataFrame(
        [("{a", "bad: x; worse: y", when(11), "p", DAY), ("{b", "bad: x", when(12), "p", DAY),
         ("{c", "late: z", when(13), "p", dt.date(2026, 6, 26))],
        DEAD_LETTER_SCHEMA,
    )


@pytest.fixture(scope="module")
def aggregates(spark):
    def row(start, symbol, exchange, avg, volume, count):
        return (start, start + dt.timedelta(minutes=1), symbol, exchange, avg, avg + 1, avg - 1,
                volume, count, 0.0, start.date(), start)

    return spark.createDataFrame(
        [
            row(when(9), "A", "NYSE", 10.0, 100, 1),
            row(when(9), "A", "NASDAQ", 20.0, 300, 3),
            row(when(10), "B", "NYSE", 40.0, 250, 4),
        ],
        AGGREGATE_SCHEMA,
    )


def test_latest_prices_takes_one_event_and_recent_days(raw):
    rows = {r.symbol: r for r in views.latest_prices(raw, now()).collect()}
    assert set(rows) == {"A", "C"}
    assert rows["A"].latest_price == 11.0 and rows["A"].last_seen == when(10)


def test_recent_prunes_partitions(raw, spark, tmp_path):
    raw.write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    df = views.recent(spark.read.parquet(str(tmp_path / "t")), now())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert df.count() == 4


def test_hourly_events_and_heatmap(raw):
    hourly = views.hourly_events(raw)
    ten = hourly.filter("symbol = 'A' AND event_hour = 10").first()
    assert (ten.event_count, ten.avg_price, ten.total_volume) == (2, 11.5, 250)
    heat = {r.symbol: r for r in views.hourly_heatmap(hourly).collect()}
    assert len(heat["A"]) == 25
    assert (heat["A"].h09, heat["A"].h10, heat["A"].h11) == (1, 2, None)


def test_dlq_rate_is_a_full_outer_join_safe_on_zero(raw, letters):
    df = views.dlq_rate(raw, letters)
    rows = {r.event_date.day: r for r in df.collect()}
    assert list(rows) == [22, 24, 25, 26]
    assert (rows[25].valid_count, rows[25].dlq_count, rows[25].dlq_rate_pct) == (3, 2, 40.0)
    assert (rows[26].valid_count, rows[26].dlq_rate_pct) == (0, 100.0)
    assert rows[22].dlq_rate_pct == 0.0


def test_dlq_measures(aggregates, letters):
    assert tuple(views.dlq_measures(aggregates, letters).first()) == (8, 3, pytest.approx(300 / 11))
    empty = views.dlq_measures(aggregates.limit(0), letters.limit(0)).first()
    assert tuple(empty) == (0, 0, None)


def test_kpis_mean_of_means_and_weighted(aggregates):
    row = views.kpi_measures(aggregates).first()
    assert row.avg_price == pytest.approx(70 / 3)
    assert row.event_weighted_avg_price == pytest.approx((10 + 60 + 160) / 8)
    assert (row.max_price, row.min_price, row.total_volume, row.event_count) == (41.0, 9.0, 650, 8)


def test_top_symbols_distribution_series(aggregates):
    assert [tuple(r) for r in views.top_symbols(aggregates, 1).collect()] == [("A", 400, 2)]
    shares = {r.exchange: (r.event_count, r.share_pct) for r in
              views.market_distribution(aggregates).collect()}
    assert shares == {"NYSE": (5, 62.5), "NASDAQ": (3, 37.5)}
    assert [(r.symbol, r.avg_price) for r in views.price_over_time(aggregates).collect()] == [
        ("A", 15.0), ("B", 40.0),
    ]


def test_error_reason_reports(letters):
    assert [tuple(r) for r in views.top_error_reasons(letters).collect()] == [
        ("bad: x", 2), ("late: z", 1),
    ]
    assert views.error_reasons(letters).count() == 3
    assert [r.original_message for r in views.letter_listing(letters, 2).collect()] == ["{c", "{b"]


def test_calendar_covers_empty_days(raw):
    days = [r.date.day for r in views.calendar(raw).orderBy("date").collect()]
    assert days == [22, 23, 24, 25]
    per_day = {r.date.day: r.event_count for r in views.events_per_day(raw).collect()}
    assert per_day == {22: 1, 23: 0, 24: 1, 25: 3}
    assert views.calendar(raw.limit(0)).count() == 0


def test_slices(raw):
    assert views.slice_table(raw, dates=("2026-06-24", "2026-06-25")).count() == 4
    assert views.slice_table(raw, companies=["A Inc."], exchanges=["NYSE"]).count() == 3


def test_selected_value(raw):
    rows = raw.groupBy("symbol").agg(
        views.selected_value("company").alias("company"), views.selected_value("price").alias("price")
    )
    got = {r.symbol: (r.company, r.price) for r in rows.collect()}
    assert got["A"] == ("A Inc.", None) and got["C"] == ("C Inc.", 30.0)


def test_counts_offsets_latest(raw, letters, bus, event):
    counts = {r.table: r.rows for r in views.row_counts({"raw": raw, "dlq": letters}).collect()}
    assert counts == {"raw": 5, "dlq": 3}
    row = views.offset_totals(decode_records(bus(event(), event()))).first()
    assert (row.records, row.end_offsets, row.partitions) == (2, 2, 1)
    assert [r.event_id for r in views.latest_events(raw, 2).collect()] == ["2", "3"]


def test_views_by_name(spark, raw, letters, aggregates):
    views.register_views(spark, raw, letters, now())
    assert spark.table("vw_latest_prices").count() == 2
    assert spark.table("vw_hourly_events").count() == 4
    assert spark.table("vw_dlq_rate").count() == 4
    assert set(views.overview_page(raw, aggregates)) == {
        "kpis", "price_over_time", "top_symbols", "market_distribution", "hourly_heatmap",
    }
    assert all(df.count() for df in views.quality_page(raw, letters).values())


def test_scorecard(bus, event):
    records = decode_records(
        bus(event(), event(), event(event_id="2", price=-1.0), event(event_id="3", symbol=None),
            event(event_id="4", timestamp="2026-06-20T00:00:00Z"), "{oops")
    )
    judged = quality.judge_records(records, now())
    row = quality.scorecard(judged).first()
    assert (row.total_records, row.valid_records, row.invalid_records) == (6, 3, 3)
    assert row.duplicate_records == 1
    assert (row.completeness, row.validity) == (66.67, 50.0)
    assert (row.uniqueness, row.timeliness, row.consistency) == (83.33, 66.67, 66.67)
    assert (row.overall_score, row.grade) == (66.67, "red")
    assert quality.scorecard(judged, approximate=True).first().duplicate_records == 1
    reasons = {r.reason: r["count"] for r in quality.top_reasons(judged, by_code=True).collect()}
    assert reasons == {"invalid_price": 1, "null_value": 1, "corrupted_json": 1}


def test_empty_scorecard_is_perfect(bus, spark):
    records = decode_records(bus("{}")).limit(0)
    row = quality.scorecard(quality.judge_records(records, now())).first()
    assert (row.total_records, row.overall_score, row.grade) == (0, 100.0, "green")


def test_scores(spark):
    df = spark.range(1).select(
        score_pct(F.lit(1), F.lit(3)).alias("a"), score_pct(F.lit(0), F.lit(0)).alias("b"),
        rate_pct(F.lit(1), F.lit(0)).alias("c"), grade(F.lit(95.0)).alias("d"),
        grade(F.lit(80.0)).alias("e"), grade(F.lit(79.9)).alias("f"),
    )
    assert tuple(df.first()) == (33.33, 100.0, None, "green", "amber", "red")


def test_rounded_mean_does_not_depend_on_order(spark):
    values = [17.55, 17.54, 17.56, 17.53]
    means = {
        spark.createDataFrame([(v,) for v in order], "x double").coalesce(1)
        .agg(rounded_mean("x", 2).alias("m")).first().m
        for order in (values, values[::-1], sorted(values))
    }
    assert means == {17.55}


def test_dlq_rate_alerts(spark):
    rates = spark.createDataFrame(
        [(DAY, 90, 10), (DAY, 91, 9), (DAY, 0, 0)], "event_date date, valid_count long, dlq_count long"
    )
    rows = alerts.dlq_rate_alerts(rates).collect()
    assert [r.message for r in rows] == ["10/100 records dead-lettered (10.0%) - exceeds threshold"]
    assert rows[0].severity == "critical"


def test_lag_and_termination_alerts(spark):
    metrics = spark.createDataFrame(
        [("q", "r", 0, when(9), 1, 1.0, 1.0, 120_000.0, 0, 0, "i"),
         ("q", "r", 1, when(10), 1, 1.0, 1.0, 120_001.0, 0, 0, "i")],
        METRICS_SCHEMA,
    )
    rows = alerts.lag_alerts(metrics).collect()
    assert [(r["at"], r.title) for r in rows] == [(when(10), "High processing lag")]
    ends = spark.createDataFrame(
        [("a", when(9), None), ("b", when(9), "boom")], "query_id string, at timestamp, exception string"
    )
    assert [r.message for r in alerts.termination_alerts(ends).collect()] == ["Query b failed: boom"]


def test_quiet_minutes_count_empty_ones(spark):
    stamps = [when(23, 58)] * 6 + [when(0, 1, day=26)] * 2
    df = spark.createDataFrame([(t,) for t in stamps], "event_ts timestamp")
    quiet = alerts.quiet_minutes(df, AlertThresholds(min_events_per_minute=5)).orderBy("minute")
    assert [(r.minute, r.event_count) for r in quiet.collect()] == [
        (when(23, 59), 0), (when(0, 0, day=26), 0), (when(0, 1, day=26), 2),
    ]
    assert alerts.stall_alerts(df).count() == 3


def test_severity_and_outcomes(spark):
    df = spark.createDataFrame([("critical",), ("fatal",), (None,)], "s string")
    got = [r.x for r in df.select(alerts.known_severity(F.col("s")).alias("x")).collect()]
    assert got == ["critical", "warning", "warning"]
    tagged = spark.createDataFrame([(None,), ("x",), (None,)], "_error_reason string")
    assert {r.outcome: r.records for r in alerts.outcome_counts(tagged).collect()} == {
        "delivered": 2, "dlq": 1,
    }
