"""Compaction of streamed tables, and retention of what nobody needs any more.

A stream leaves a few small files per micro-batch and date.  `compact` rewrites the
closed dates of a table into few clustered files and swaps the manifest that readers
follow (`sources.compacted`).  A failure before the swap leaves the table as it was; the
files written by then are no one's and go with `vacuum`.

`retire` deletes the files of a folder between stages once every stream that reads it
has committed them, as the readers' own checkpoints tell.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TableLayout
from ..sources.compacted import (
    compaction_folder,
    exists,
    files_by_date,
    path_of,
    read_manifest,
    replaced_names,
    stragglers,
    swap_manifest,
)
from .tables import clustered, rows_by_date


def compact(
    spark: SparkSession, base: str, layout: TableLayout, before: str, file_rows: int = 5_000_000
) -> list[str]:
    """Rewrite the dates before ``before`` that have streamed files; the dates rewritten.

    A date gets about one file per ``file_rows`` rows, cut by ranges over the cluster
    columns and a tail that keeps a hot value splittable, and at most one file more
    for each end of its range.  Rows that reach a compacted date later are read beside
    it, and taken in the next time.
    """
    folder = f"{base}/{layout.name}"
    dates = read_manifest(spark, base, layout)
    streamed = spark.read.schema(layout.schema).parquet(folder)
    files = files_by_date(streamed, layout)
    late = set(stragglers(spark, base, layout, files, dates))
    due = sorted(
        d for d, names in files.items() if d < before and (d not in dates or late.intersection(names))
    )
    if not due:
        return []
    date = F.col(layout.partition_by).cast("string")
    new = [f for d in due for f in files[d] if d not in dates or f in late]
    rows = spark.read.schema(layout.schema).option("basePath", folder).parquet(*new)
    for name in sorted({dates[d]["folder"] for d in due if d in dates}):
        held = [d for d in due if d in dates and dates[d]["folder"] == name]
        old = spark.read.schema(layout.schema).parquet(f"{compaction_folder(base, layout)}/{name}")
        rows = rows.unionByName(old.where(date.isin(*held)))
    generation = f"generation-{uuid.uuid4().hex}"
    path = f"{compaction_folder(base, layout)}/{generation}"
    laid = clustered(rows, layout, rows_by_date(rows, layout), file_rows)
    laid.write.partitionBy(layout.partition_by).parquet(path)
    names = [(f.rpartition("/")[2],) for f in new]
    spark.createDataFrame(names, "name string").coalesce(1).write.parquet(f"{path}-replaced")
    for d in due:
        before_it = dates.get(d, {"folders": []})["folders"]
        dates[d] = {"folder": generation, "folders": [*before_it, generation], "replaced": len(files[d])}
    swap_manifest(spark, base, layout, dates)
    return due


def consumed(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``(path)`` of the source files that a stream over files has committed."""
    commits, offsets = f"{checkpoint}/commits", f"{checkpoint}/offsets"
    none = spark.createDataFrame([], "path string")
    if not exists(spark, commits):
        return none
    place, system = path_of(spark, commits)
    done = [int(s.getPath().getName()) for s in system.listStatus(place) if s.getPath().getName().isdigit()]
    if not done:
        return none
    log = [r.value for r in spark.read.text(f"{offsets}/{max(done)}").collect()]
    through = json.loads(log[-1])["logOffset"]
    entry = F.from_json("value", "path string, batchId long")
    entries = spark.read.text(f"{checkpoint}/sources/0").where("value LIKE '{%'").select(entry.alias("e"))
    return entries.where(F.col("e.batchId") <= through).select("e.path").distinct()


def retire(spark: SparkSession, folder: str, readers: list[str]) -> int:
    """Delete files of ``folder`` that all ``readers`` (checkpoints) are done with.

    A stream over the folder that starts without a checkpoint finds them gone.
    """
    seen = reduce(DataFrame.intersect, [consumed(spark, r) for r in readers])
    return _delete(spark, seen, folder)


def _delete(spark: SparkSession, paths: DataFrame, folder: str) -> int:
    deleted = 0
    _, system = path_of(spark, folder)
    inside = system.makeQualified(path_of(spark, folder)[0]).toUri().getPath()
    for row in paths.toLocalIterator():
        place, _ = path_of(spark, unquote(row.path))
        if place.toUri().getPath().startswith(f"{inside}/") and system.delete(place, False):
            deleted += 1
    return deleted


def vacuum(spark: SparkSession, base: str, layout: TableLayout, readers: list[str]) -> int:
    """Delete streamed files that are compacted and that all ``readers`` are done with,
    and generations no date uses; the number of streamed files deleted.

    For when no reader or compaction that began before the last swap is still running.
    From then on the table is to be read by `read_table`.
    """
    dates = read_manifest(spark, base, layout)
    if not dates:
        return 0
    used = {d["folder"] for d in dates.values()}
    listed = {f for d in dates.values() for f in d["folders"]}
    place, system = path_of(spark, compaction_folder(base, layout))
    for status in system.listStatus(place):
        name = status.getPath().getName()
        stale = name.startswith("generation-") and not name.endswith("-replaced") and name not in used
        if stale or (name.endswith("-replaced") and name.removesuffix("-replaced") not in listed):
            system.delete(status.getPath(), True)
    folder = f"{base}/{layout.name}"
    streamed = spark.read.schema(layout.schema).parquet(folder)
    gone = replaced_names(spark, base, layout, listed)
    paths = [(f,) for fs in files_by_date(streamed, layout).values() for f in fs if f.rpartition("/")[2] in gone]
    found = spark.createDataFrame(paths, "path string")
    if readers:
        name = F.substring_index("path", "/", -1)
        done = reduce(DataFrame.intersect, [consumed(spark, r).select(name.alias("name")) for r in readers])
        found = found.withColumn("name", name).join(done, "name", "left_semi").drop("name")
    return _delete(spark, found, folder)
