"""Holding back repeated alerts.

One alert per title goes out, then none until the cool-down has passed.  A suppressed
alert does not restart the clock, so whether one is sent depends on all earlier ones of
its title: a sequence, which no single task may hold.

**Slices.**  Alerts are sorted by range of (title, time) and every partition is cut by
counted rows, so a slice has ``slice_rows`` alerts at most however dense they are.

**Maps.**  All that a slice needs to know of the past is from when on its title may send
again, and all that it hands on is the same.  That is a map from one time to another,
constant on pieces (all starts between two alerts begin with the same alert) and the
identity after its last alert; a piece is ``(begin, end)``, the last alert it applies to
and the alert it would send last.  Starts that lead to one end are one piece, and only
starts within a cool-down of the first alert can occur.

**Levels.**  Maps compose.  ``fan`` neighbouring slices become one node, ``fan`` nodes
one of the next level, until a title is a handful of nodes.  Then times are handed back
down: a node's start gives the starts of its children.  Both ways stream through sorted
nodes, one at a time: memory is two maps, each of at most the alerts of one title within
a cool-down (16 bytes an alert).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.alerts import known_severity
from ..settings import settle

_NEVER = np.iinfo(np.int64).min
_NODE = "title string, _node long, _first long, _begins array<long>, _ends array<long>"
_FREE = "title string, _node long, _free_from long"


def cooled_down(
    alerts: DataFrame, cooldown_seconds: float = 60.0, slice_rows: int = 10_000, fan: int = 256
) -> DataFrame:
    """The alerts that go out: one per title, then none until the cool-down has passed.

    Of alerts with one title and one time only the first by severity and
    message can go out; the others are dropped before any shuffle.  ``at``
    must not be NULL; a NULL title is a title like any other.
    """
    cooldown = int(cooldown_seconds * 1_000_000)
    alerts = alerts.withColumn("severity", known_severity(F.col("severity")))
    if cooldown <= 0:
        return alerts
    sliced = slices(alerts, slice_rows)
    times = sliced.select("title", "_node", "_at")
    nodes = settle(
        times.groupBy("title", "_node").applyInPandas(_summarise(cooldown), _NODE), "cooldown-maps"
    )
    levels = [nodes]
    last = nodes.agg(F.max("_node")).first()[0] or 0
    while last >= fan:
        levels.append(settle(compose(levels[-1], cooldown, fan), "cooldown-maps"))
        last //= fan
    free = levels.pop().withColumn("_start", F.lit(_NEVER))
    free = settle(hand_down(free, cooldown, F.lit(0)), "cooldown-starts")
    for level in reversed(levels):
        parents = free.select("title", F.col("_node").alias("_of"), F.col("_free_from").alias("_start"))
        children = _with(level.withColumn("_of", _parent(fan)), parents, "_of")
        free = settle(hand_down(children, cooldown, F.col("_of")), "cooldown-starts")
    sent = (
        _with(times, free, "_node")
        .groupBy("title", "_node")
        .applyInPandas(_send(cooldown), "title string, _node long, _at long")
    )
    return sliced.join(
        sent.select(F.col("_node").alias("_in"), F.col("title").alias("_of"), F.col("_at").alias("_sent")),
        (F.col("_node") == F.col("_in")) & (F.col("_at") == F.col("_sent")) & F.col("title").eqNullSafe(F.col("_of")),
        "left_semi",
    ).select(*alerts.columns)


def slices(alerts: DataFrame, slice_rows: int) -> DataFrame:
    """The instants of every title with ``_at`` (microseconds) and ``_node``, settled.

    A node has ``slice_rows`` rows at most, and the nodes of a title follow one another.
    """
    first = Window.partitionBy("title", "at").orderBy("severity", "message")
    instants = alerts.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1").drop("_nth")
    ranged = (
        instants.withColumn("_at", F.unix_micros("at"))
        .repartitionByRange("title", "_at")
        .sortWithinPartitions("title", "_at")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    ranged = settle(
        ranged.withColumn("_cut", F.floor(F.col("_place").bitwiseAND((1 << 33) - 1) / slice_rows)), "alerts"
    )
    cuts = (ranged.agg(F.max("_cut")).first()[0] or 0) + 1
    node = F.shiftrightunsigned("_place", 33) * cuts + F.col("_cut")
    return ranged.withColumn("_node", node.cast("long")).drop("_place", "_cut")


def _parent(fan: int) -> Column:
    return F.floor(F.col("_node") / fan).cast("long")


def _with(children: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    """Each child with what is known of its node."""
    parents = parents.withColumnsRenamed({"title": "_title", on: "_on"})
    same = children["title"].eqNullSafe(parents["_title"]) & (children[on] == parents["_on"])
    return children.join(parents, same).drop("_title", "_on")


def _in_order(nodes: DataFrame, group: Column) -> DataFrame:
    """Nodes dealt out by (title, group) and sorted, a few per Arrow batch whatever their size."""
    grouped = nodes.withColumn("_group", group)
    return grouped.repartition("title", "_group").sortWithinPartitions("title", "_group", "_node")


def _walk(batches: Iterator[pa.RecordBatch]):
    """``(new, row)`` of sorted nodes; ``new`` where another (title, group) begins."""
    last = None
    for batch in batches:
        maps = [batch[c] for c in ("_begins", "_ends")]
        rest = batch.drop_columns(["_begins", "_ends"]).to_pylist()
        for k, row in enumerate(rest):
            row["_begins"], row["_ends"] = (m.slice(k, 1).flatten().to_numpy(zero_copy_only=False) for m in maps)
            now = (row["title"], row["_group"])
            yield now != last, row
            last = now


def _merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that lead to one end as one, with the last of their begins."""
    kept = np.append(ends[1:] != ends[:-1], True) if len(ends) else np.zeros(0, bool)
    return begins[kept], ends[kept]


def compose(nodes: DataFrame, cooldown: int, fan: int) -> DataFrame:
    """The next level: the map of every ``fan`` neighbouring nodes of a title."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = None
        for new, row in _walk(batches):
            if new:
                if node:
                    yield _as_batch(node)
                node = {k: row[k] for k in ("title", "_first", "_begins", "_ends")} | {"_node": row["_group"]}
                continue
            node["_begins"], node["_ends"] = _after(node, row, cooldown)
        if node:
            yield _as_batch(node)

    return _in_order(nodes, _parent(fan)).mapInArrow(run, _NODE)


def _after(node: dict, then: dict, cooldown: int) -> tuple[np.ndarray, np.ndarray]:
    """The map of ``node`` followed by ``then``."""
    begins, ends = node["_begins"], node["_ends"]
    free = ends + cooldown
    piece = np.searchsorted(then["_begins"], free)
    hit = piece < len(then["_begins"])
    ends = ends.copy()
    ends[hit] = then["_ends"][piece[hit]]
    # starts behind the last alert reach the next node as they are
    limit = node["_first"] + cooldown
    if not len(begins) or begins[-1] < limit:
        low = np.searchsorted(then["_begins"], begins[-1], "right") if len(begins) else 0
        high = np.searchsorted(then["_begins"], limit) + 1
        begins = np.append(begins, then["_begins"][low:high])
        ends = np.append(ends, then["_ends"][low:high])
    return _merged(begins, ends)


def _as_batch(node: dict) -> pa.RecordBatch:
    lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, pa.int64()))
             for v in (node["_begins"], node["_ends"])]
    return pa.RecordBatch.from_arrays(
        [pa.array([node["title"]], pa.string()), pa.array([node["_node"]], pa.int64()),
         pa.array([node["_first"]], pa.int64()), *lists],
        ["title", "_node", "_first", "_begins", "_ends"],
    )


def hand_down(nodes: DataFrame, cooldown: int, group: Column) -> DataFrame:
    """From when on each node may send, given ``_start``, the same of its group's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, free = [], _NEVER
        for new, row in _walk(batches):
            free = row["_start"] if new else free
            out.append((row["title"], row["_node"], free))
            piece = np.searchsorted(row["_begins"], free)
            if piece < len(row["_begins"]):
                free = int(row["_ends"][piece]) + cooldown
            if len(out) == 4096:
                yield _free_batch(out)
                out = []
        if out:
            yield _free_batch(out)

    return _in_order(nodes, group).mapInArrow(run, _FREE)


def _free_batch(rows: list[tuple]) -> pa.RecordBatch:
    title, node, free = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(title, pa.string()), pa.array(node, pa.int64()), pa.array(free, pa.int64())],
        ["title", "_node", "_free_from"],
    )


def _summarise(cooldown: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(group["_at"].to_numpy())
        following = np.searchsorted(at, at + cooldown)
        begins = np.arange(min(np.searchsorted(at, at[0] + cooldown) + 1, len(at)))
        ends = begins.copy()
        while True:
            step = following[ends]
            on = step < len(at)
            if not on.any():
                break
            ends[on] = step[on]
        begins, ends = _merged(at[begins], at[ends])
        return pd.DataFrame(
            {
                "title": [group["title"].iloc[0]],
                "_node": [group["_node"].iloc[0]],
                "_first": [at[0]],
                "_begins": [begins],
                "_ends": [ends],
            }
        )

    return run


def _send(cooldown: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(group["_at"].to_numpy())
        sent, i = [], int(np.searchsorted(at, group["_free_from"].iloc[0]))
        while i < len(at):
            sent.append(at[i])
            i = int(np.searchsorted(at, at[i] + cooldown))
        out = pd.DataFrame({"_at": np.array(sent, "int64")})
        return out.assign(title=group["title"].iloc[0], _node=group["_node"].iloc[0])[["title", "_node", "_at"]]

    return run
