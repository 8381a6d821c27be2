"""Change from one tick to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..settings import settle
from .windows import interval_seconds

_BEFORE_ALL = -(2**63)  # where events without a time go


def tick_change(
    events: DataFrame,
    key: str = "symbol",
    order: tuple[str, ...] = ("event_ts", "event_id"),
    value: str = "price",
    slice_width: str = "1 hour",
    max_slice_rows: int = 2_000_000,
    fan: int = 1_000,
) -> DataFrame:
    """Recompute ``change`` and ``change_percent`` against the key's previous tick.

    The first tick of a key changes by 0, and so does, in percent, one after
    a value of 0.  Ticks must be unique on ``key`` and ``order``.

    A plain ``lag`` per key would put all ticks of a hot key into one task.
    Here each key is cut into time slices that are lagged on their own, and the
    ticks of a slice with more than ``max_slice_rows`` are cut further, into equal
    ranges of (key, order); other slices stay as they are.  The last value of a
    slice is handed to the next one in levels: slices within a block of ``fan``,
    blocks within a block of blocks, so no task holds all slices of a key.
    """
    width = int(interval_seconds(slice_width) * 1_000_000)
    events = settle(events, "ticks")  # read for the slices' ends and for the result
    since = F.unix_micros(F.col(order[0]).cast("timestamp"))
    number = F.coalesce(F.floor(since / width).cast("long"), F.lit(_BEFORE_ALL))
    sliced = events.withColumn("_slice", number)
    ends = settle(_slice_ends(sliced.withColumn("_part", F.lit(0)), key, order, value), "tick-slices")
    hot = ends.filter(F.col("_rows") > max_slice_rows)
    n_hot, hot_rows = hot.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    if n_hot:
        # a hot slice has more than max_slice_rows rows, so this table is that much smaller
        named = hot.select(F.col(key).alias("_key"), F.col("_slice").alias("_at"))
        same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_at"))
        cold = sliced.join(F.broadcast(named), same, "left_anti").withColumn("_part", F.lit(0))
        ranged = sliced.join(F.broadcast(named), same, "left_semi").repartitionByRange(
            2 * -(-hot_rows // max_slice_rows), key, *order
        )
        # Settled, because both uses below must see one and the same cut.
        ranged = settle(ranged.withColumn("_part", F.spark_partition_id()), "ticks")
        ends = ends.filter(F.col("_rows") <= max_slice_rows)
        ends = ends.unionByName(_slice_ends(ranged, key, order, value))
        sliced = cold.unionByName(ranged)
    else:
        sliced = sliced.withColumn("_part", F.lit(0))

    carry = handed_on(ends, key, fan).select(
        F.col(key).alias("_of_key"), F.col("_slice").alias("_of_slice"),
        F.col("_part").alias("_of_part"), "_carried",
    )
    within = Window.partitionBy(key, "_slice", "_part").orderBy(*order)
    lagged = sliced.withColumns(
        {"_before": F.lag(value).over(within), "_nth": F.row_number().over(within)}
    )
    joined = lagged.join(
        carry,
        lagged[key].eqNullSafe(carry["_of_key"])
        & (lagged["_slice"] == carry["_of_slice"])
        & (lagged["_part"] == carry["_of_part"]),
        "left",
    )
    previous = F.coalesce(
        F.when(F.col("_nth") == 1, F.col("_carried")).otherwise(F.col("_before")), F.col(value)
    )
    change = F.round(F.col(value) - F.col("_previous"), 4)
    percent = F.coalesce(
        F.try_divide(F.col("change"), F.col("_previous")) * 100, F.lit(0.0)
    )
    return (
        joined.withColumn("_previous", previous)
        .withColumn("change", change)
        .withColumn("change_percent", F.round(percent, 4))
        .drop("_slice", "_part", "_before", "_nth", "_of_key", "_of_slice", "_of_part", "_carried", "_previous")
    )


def _slice_ends(sliced: DataFrame, key: str, order: tuple[str, ...], value: str) -> DataFrame:
    """Row count and last value of every (key, slice, part)."""
    return sliced.groupBy(key, "_slice", "_part").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max_by(value, F.struct(*order)).alias("_last"),
    )


def handed_on(ends: DataFrame, key: str, fan: int) -> DataFrame:
    """``(key, _slice, _part, _carried)``: the last value before each slice."""
    level = ends.select(
        key, F.col("_slice").alias("_block"), F.col("_part").cast("long").alias("_number"), "_last"
    )
    carried = _carried(settle(level, "tick-slices"), key, fan)
    return carried.select(key, F.col("_block").alias("_slice"), F.col("_number").alias("_part"), "_carried")


def _carried(level: DataFrame, key: str, fan: int) -> DataFrame:
    """``level`` with ``_carried``, the ``_last`` of the row before in (block, number).

    Keys with at most ``fan`` rows are lagged as they are.  Otherwise rows are lagged
    within their blocks, and a block's first row takes what is carried to its block,
    a row of the next level.
    """
    rows = level.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if rows <= fan:
        before = Window.partitionBy(key).orderBy("_block", "_number")
        return level.withColumn("_carried", F.lag("_last").over(before))
    within = Window.partitionBy(key, "_block").orderBy("_number")
    lagged = level.withColumns(
        {"_carried": F.lag("_last").over(within), "_first": F.row_number().over(within) == 1}
    )
    tops = level.groupBy(key, "_block").agg(F.max_by("_last", "_number").alias("_last"))
    tops = tops.select(
        key, F.floor(F.col("_block") / fan).cast("long").alias("_of"), F.col("_block").alias("_number"), "_last"
    ).withColumnRenamed("_of", "_block")
    above = _carried(settle(tops, "tick-blocks"), key, fan).select(
        F.col(key).alias("_key"), F.col("_number").alias("_in"), F.col("_carried").alias("_above")
    )
    joined = lagged.join(above, lagged[key].eqNullSafe(above["_key"]) & (lagged["_block"] == above["_in"]))
    return joined.withColumn(
        "_carried", F.when(F.col("_first"), F.col("_above")).otherwise(F.col("_carried"))
    ).drop("_first", "_key", "_in", "_above")
