"""Data-quality scorecard over raw JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import RuleBounds
from ..functions.parse import add_once
from ..functions.rules import (
    failure_list,
    first_reason,
    is_complete,
    is_consistent,
    is_timely,
    read_json,
)
from ..functions.scores import grade, score_pct

_DIMENSIONS = ("completeness", "validity", "uniqueness", "timeliness", "consistency")


def judge_records(
    records: DataFrame,
    as_of: Column | None = None,
    bounds: RuleBounds = RuleBounds(),
    raw: str = "raw_value",
) -> DataFrame:
    """Per record its event id, the scorecard's yes/no answers and all reasons."""
    now = F.current_timestamp() if as_of is None else as_of
    read = add_once(read_json(records, raw), reasons=failure_list(now, bounds, raw))
    return read.select(
        F.col("_s_event_id").alias("event_id"),
        is_complete(bounds).alias("complete"),
        (F.size("reasons") == 0).alias("valid"),
        is_consistent(bounds).alias("consistent"),
        is_timely(now, bounds).alias("timely"),
        F.concat_ws("; ", "reasons").alias("error_reason"),
    )


def duplicate_count(key: str = "event_id", approximate: bool = False) -> Column:
    """Aggregate: how many rows repeat a key already seen; NULL keys do not count.

    The exact count shuffles the distinct keys; the approximate one a sketch.
    """
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    return F.count(key) - distinct


def scorecard(judged: DataFrame, approximate: bool = False) -> DataFrame:
    """The five scores, their mean and the totals, as one row.

    One pass; rows are combined per event id before the shuffle, or, when an
    approximate duplicate count will do, before one row per task is.  No
    records at all score 100 everywhere.
    """
    counted = judged.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("complete").alias("_complete"),
        F.count_if("valid").alias("valid_records"),
        F.count_if("consistent").alias("_consistent"),
        F.count_if("timely").alias("_timely"),
        duplicate_count(approximate=approximate).alias("duplicate_records"),
    )
    total = F.col("total_records")
    scored = counted.select(
        total,
        "valid_records",
        (total - F.col("valid_records")).alias("invalid_records"),
        "duplicate_records",
        score_pct(F.col("_complete"), total).alias("completeness"),
        score_pct(F.col("valid_records"), total).alias("validity"),
        score_pct(total - F.col("duplicate_records"), total).alias("uniqueness"),
        score_pct(F.col("_timely"), total).alias("timeliness"),
        score_pct(F.col("_consistent"), total).alias("consistency"),
    )
    mean = sum((F.col(d) for d in _DIMENSIONS), F.lit(0.0)) / len(_DIMENSIONS)
    overall = scored.withColumn("overall_score", F.round(mean, 2))
    return overall.withColumn("grade", grade(F.col("overall_score")))


def report(
    judged: DataFrame, pipeline_name: str, environment: str, rows: int = 10
) -> DataFrame:
    """The scorecard with whose it is and its most frequent reasons; one row."""
    reasons = top_reasons(judged, rows).agg(
        F.array_sort(F.collect_list(F.struct(-F.col("count"), "reason"))).alias("_sorted")
    )
    reasons = reasons.select(
        F.transform("_sorted", lambda r: F.struct(r["reason"].alias("reason"), (-r["col1"]).alias("count")))
        .alias("top_error_reasons"),
        F.lit(1).alias("_one"),
    )
    card = scorecard(judged).withColumn("_one", F.lit(1))
    named = card.join(reasons, "_one").drop("_one")
    return named.select(
        F.lit(pipeline_name).alias("pipeline_name"), F.lit(environment).alias("environment"), "*"
    )


def top_reasons(judged: DataFrame, rows: int = 10, by_code: bool = False) -> DataFrame:
    """The most frequent first reasons of invalid records; ties by reason.

    Reasons quote the offending values, which splinters the counts;
    ``by_code`` counts the bare rule codes instead.
    """
    reason = first_reason(F.col("error_reason"))
    if by_code:
        reason = F.split_part(reason, F.lit(":"), F.lit(1))
    counted = (
        judged.filter(~F.col("valid"))
        .groupBy(reason.alias("reason"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counted.orderBy(F.desc("count"), "reason").limit(rows)
