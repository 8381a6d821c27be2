"""Reports over the three output tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rules import first_reason
from ..functions.scores import rate_pct, rounded_mean
from ..settings import settle

HOURS = list(range(24))


def _rows() -> Column:
    return F.count(F.lit(1))


# --- filters ------------------------------------------------------------------


def recent(table: DataFrame, as_of: Column | None = None, days: int = 1) -> DataFrame:
    """Rows dated ``days`` before ``as_of`` or later; prunes date partitions."""
    today = F.current_date() if as_of is None else F.to_date(as_of)
    return table.filter(F.col("event_date") >= F.date_sub(today, days))


def slice_table(
    table: DataFrame,
    dates: tuple | None = None,
    companies: Iterable[str] | None = None,
    exchanges: Iterable[str] | None = None,
) -> DataFrame:
    """Restrict a table to a date range (both ends included), companies and exchanges."""
    if dates is not None:
        table = table.filter(F.col("event_date").between(F.lit(dates[0]), F.lit(dates[1])))
    if companies is not None:
        table = table.filter(F.col("company").isin(*companies))
    if exchanges is not None:
        table = table.filter(F.col("exchange").isin(*exchanges))
    return table


# --- over raw events ----------------------------------------------------------


def latest_prices(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per symbol the newest recent event's company, exchange and price.

    All fields come from one event, the last by (event_timestamp, event_id).
    """
    newest = F.max_by(
        F.struct("company", "exchange", "price", "event_timestamp"),
        F.struct("event_timestamp", "event_id"),
    )
    return (
        recent(raw, as_of)
        .groupBy("symbol")
        .agg(newest.alias("newest"))
        .select(
            "symbol",
            "newest.company",
            "newest.exchange",
            F.col("newest.price").alias("latest_price"),
            F.col("newest.event_timestamp").alias("last_seen"),
        )
    )


def hourly_events(raw: DataFrame) -> DataFrame:
    """Events, average price and volume per date, hour, symbol and exchange."""
    return raw.groupBy("event_date", "event_hour", "symbol", "exchange").agg(
        _rows().alias("event_count"),
        rounded_mean("price", 2).alias("avg_price"),
        F.sum("volume").alias("total_volume"),
    )


def hourly_heatmap(hourly: DataFrame) -> DataFrame:
    """Symbols by hours of the day: event counts, one column per hour."""
    table = hourly.groupBy("symbol").pivot("event_hour", HOURS).agg(F.sum("event_count"))
    return table.select("symbol", *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def latest_events(raw: DataFrame, rows: int = 5, by: str = "processing_time") -> DataFrame:
    """The newest events, for a look at what is landing."""
    return (
        raw.orderBy(F.desc(by), F.desc("event_timestamp"), "event_id")
        .limit(rows)
        .select(
            "event_id", "symbol", F.round("price", 2).alias("price"), "volume", "exchange",
            "event_hour",
        )
    )


def calendar(raw: DataFrame, column: str = "event_date") -> DataFrame:
    """Every day from the first to the last date of a table."""
    ends = raw.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    days = ends.filter(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date")
    )
    return days.select(
        "date",
        F.year("date").cast("long").alias("year"),
        F.month("date").cast("long").alias("month"),
        F.dayofmonth("date").cast("long").alias("day"),
    )


def events_per_day(raw: DataFrame) -> DataFrame:
    """Events and volume for every calendar day, days without events included."""
    daily = raw.groupBy("event_date").agg(
        _rows().alias("event_count"), F.sum("volume").alias("total_volume")
    )
    daily = settle(daily, "daily")  # a row per day, read for the calendar and for its counts
    days = calendar(daily)
    return days.join(daily, days["date"] == daily["event_date"], "left").select(
        "date",
        F.coalesce("event_count", F.lit(0)).alias("event_count"),
        F.coalesce("total_volume", F.lit(0)).alias("total_volume"),
    )


# --- over dead letters ----------------------------------------------------------


def dlq_rate(raw: DataFrame, letters: DataFrame) -> DataFrame:
    """Per day the valid events, the dead letters and their share in percent.

    The full outer join of both daily counts, written as one aggregation over
    both tables: a day either side lacks counts 0 there, and rows are combined
    per day before the only shuffle.  Reads nothing but ``event_date``.
    """
    good = raw.select("event_date", F.lit(1).alias("_good"), F.lit(0).alias("_bad"))
    bad = letters.select("event_date", F.lit(0).alias("_good"), F.lit(1).alias("_bad"))
    counts = good.unionByName(bad).groupBy("event_date").agg(
        F.sum("_good").alias("valid_count"), F.sum("_bad").alias("dlq_count")
    )
    rate = rate_pct(F.col("dlq_count"), F.col("valid_count") + F.col("dlq_count"))
    return counts.withColumn("dlq_rate_pct", rate).orderBy("event_date")


def dlq_measures(aggregates: DataFrame, letters: DataFrame) -> DataFrame:
    """One row: events, dead letters and the dead-letter share in percent."""
    events = aggregates.agg(F.sum("event_count").alias("event_count"))
    dead = letters.agg(_rows().alias("dlq_count"))
    both = events.unionByName(dead, allowMissingColumns=True)
    totals = both.agg(
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("event_count"),
        F.coalesce(F.sum("dlq_count"), F.lit(0)).alias("dlq_count"),
    )
    rate = rate_pct(F.col("dlq_count"), F.col("event_count") + F.col("dlq_count"))
    return totals.withColumn("dlq_rate_pct", rate)


def error_reasons(letters: DataFrame) -> DataFrame:
    """Dead letters per reason."""
    return letters.groupBy("error_reason").agg(_rows().alias("dlq_count"))


def top_error_reasons(letters: DataFrame, rows: int = 10) -> DataFrame:
    """The most frequent first reasons; ties by reason."""
    counted = letters.groupBy(first_reason(F.col("error_reason")).alias("reason")).agg(
        _rows().alias("count")
    )
    return counted.orderBy(F.desc("count"), "reason").limit(rows)


def letter_listing(letters: DataFrame, rows: int | None = None) -> DataFrame:
    """The dead letters, newest first; with ``rows``, that many of them."""
    listed = letters.orderBy(F.desc("processing_timestamp"), "error_reason", "original_message")
    listed = listed if rows is None else listed.limit(rows)
    return listed.select("processing_timestamp", "error_reason", "original_message")


# --- over window aggregates ------------------------------------------------------


def kpi_measures(aggregates: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The overview figures, overall or per group.

    ``avg_price`` is the plain mean of the windows' means;
    ``event_weighted_avg_price`` weighs each window by its events.
    """
    weighted = F.try_divide(
        F.sum(F.col("avg_price") * F.col("event_count")), F.sum("event_count")
    )
    return aggregates.groupBy(*by).agg(
        F.avg("avg_price").alias("avg_price"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        F.sum("total_volume").alias("total_volume"),
        F.sum("event_count").alias("event_count"),
        weighted.alias("event_weighted_avg_price"),
    )


def price_over_time(aggregates: DataFrame) -> DataFrame:
    """Mean price per window and symbol, over all exchanges."""
    return (
        aggregates.groupBy("window_start", "symbol")
        .agg(F.avg("avg_price").alias("avg_price"))
        .orderBy("window_start", "symbol")
    )


def top_symbols(aggregates: DataFrame, rows: int = 10) -> DataFrame:
    """Symbols with the largest volume, and how many windows it came from."""
    return (
        aggregates.groupBy("symbol")
        .agg(F.sum("total_volume").alias("total_volume"), _rows().alias("windows"))
        .orderBy(F.desc("total_volume"), "symbol")
        .limit(rows)
    )


def market_distribution(aggregates: DataFrame) -> DataFrame:
    """Events per exchange and their share of all events in percent.

    The total runs over the counted exchanges, no more than the rules allow.
    """
    counts = aggregates.groupBy("exchange").agg(F.sum("event_count").alias("event_count"))
    total = F.sum("event_count").over(Window.partitionBy())
    return counts.withColumn("share_pct", rate_pct(F.col("event_count"), total))


# --- anything -----------------------------------------------------------------


def selected_value(column: str) -> Column:
    """Aggregate: the column's value when all rows agree on one, else NULL."""
    same = (F.min(column) == F.max(column)) & (F.count(column) == F.count(F.lit(1)))
    return F.when(same, F.max(column))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    counted = [
        table.agg(_rows().alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, table in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def offset_totals(parsed: DataFrame) -> DataFrame:
    """Per topic the records seen, and the records the bus has numbered so far."""
    partitions = parsed.groupBy("kafka_topic", "kafka_partition").agg(
        _rows().alias("records"), (F.max("kafka_offset") + 1).alias("end_offset")
    )
    return partitions.groupBy("kafka_topic").agg(
        F.sum("records").alias("records"),
        F.sum("end_offset").alias("end_offsets"),
        _rows().alias("partitions"),
    )


def register_views(
    spark: SparkSession,
    raw: DataFrame,
    letters: DataFrame,
    as_of: Column | None = None,
) -> None:
    """Make the three standing reports available to SQL by name."""
    latest_prices(raw, as_of).createOrReplaceTempView("vw_latest_prices")
    hourly_events(raw).createOrReplaceTempView("vw_hourly_events")
    dlq_rate(raw, letters).createOrReplaceTempView("vw_dlq_rate")


def overview_page(raw: DataFrame, aggregates: DataFrame) -> dict[str, DataFrame]:
    """The overview report: one frame per visual."""
    return {
        "kpis": kpi_measures(aggregates),
        "price_over_time": price_over_time(aggregates),
        "top_symbols": top_symbols(aggregates),
        "market_distribution": market_distribution(aggregates),
        "hourly_heatmap": hourly_heatmap(hourly_events(raw)),
    }


def quality_page(raw: DataFrame, letters: DataFrame) -> dict[str, DataFrame]:
    """The data-quality report: one frame per visual."""
    return {
        "dlq_rate_trend": dlq_rate(raw, letters),
        "error_reasons": error_reasons(letters).orderBy(F.desc("dlq_count"), "error_reason"),
        "dlq_listing": letter_listing(letters),
    }
