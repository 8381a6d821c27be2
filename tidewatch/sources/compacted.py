"""Reading tables that have been compacted.

A manifest beside a table names, for each compacted date, the folder of its clustered
files and how many streamed files they replace.  It is swapped in one rename, so a reader
sees a date either as it was streamed or as it was compacted, never both.
"""

from __future__ import annotations

import json
import re
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TableLayout


def path_of(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = path_of(spark, path)
    return system.exists(place)


def compaction_folder(base: str, layout: TableLayout) -> str:
    return f"{base}/_compaction/{layout.name}"


def read_manifest(spark: SparkSession, base: str, layout: TableLayout) -> dict[str, dict]:
    """``{date: {"folder": ..., "replaced": n}}``; empty if nothing has been compacted."""
    path = f"{compaction_folder(base, layout)}/manifest.json"
    if not exists(spark, path):
        return {}
    return json.loads(spark.read.text(path, wholetext=True).first()[0])["dates"]


def swap_manifest(spark: SparkSession, base: str, layout: TableLayout, dates: dict[str, dict]) -> None:
    """Put a new manifest in the place of the old one, in one rename."""
    jvm = spark.sparkContext._jvm
    folder = compaction_folder(base, layout)
    place, system = path_of(spark, f"{folder}/manifest.json")
    written, _ = path_of(spark, f"{folder}/.manifest-{uuid.uuid4().hex}")
    out = system.create(written)
    out.write(bytearray(json.dumps({"dates": dates}, sort_keys=True).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf).rename(written, place, how)


def files_by_date(streamed: DataFrame, layout: TableLayout) -> dict[str, list[str]]:
    """The files of a table by date, from the listing ``streamed`` was planned with."""
    found = defaultdict(list)
    for path in map(unquote, streamed.inputFiles()):
        date = re.search(f"/{layout.partition_by}=([^/]*)/", path)
        if date:
            found[date[1]].append(path)
    return found


def replaced_names(spark: SparkSession, base: str, layout: TableLayout, folders: set[str]) -> set[str]:
    """Names of the streamed files that stand in these compacted folders."""
    paths = [f"{compaction_folder(base, layout)}/{f}-replaced" for f in sorted(folders)]
    return {r.name for r in spark.read.parquet(*paths).collect()} if paths else set()


def stragglers(
    spark: SparkSession, base: str, layout: TableLayout, files: dict[str, list[str]], dates: dict[str, dict]
) -> list[str]:
    """Streamed files of compacted dates that came after their compaction.

    The log of Spark's file sink only ever grows, so there a date with as many files as
    were replaced has none.  In a plain folder names are compared.
    """
    logged = exists(spark, f"{base}/{layout.name}/_spark_metadata")
    more = [d for d in dates if len(files.get(d, ())) > (dates[d]["replaced"] if logged else 0)]
    gone = replaced_names(spark, base, layout, {f for d in more for f in dates[d]["folders"]})
    return [f for d in more for f in files[d] if f.rpartition("/")[2] not in gone]


def read_laid_out(spark: SparkSession, base: str, layout: TableLayout) -> DataFrame:
    """A table with its fixed schema: compacted dates from their clustered files, the
    others, and what has come since, from the streamed ones."""
    dates = read_manifest(spark, base, layout)
    folder = f"{base}/{layout.name}"
    reader = spark.read.schema(layout.schema)
    streamed = reader.parquet(folder)
    columns = layout.schema.fieldNames()
    if not dates:
        return streamed.select(*columns)
    date = F.col(layout.partition_by).cast("string")
    parts = [streamed.where(date.isNull() | ~date.isin(*dates))]
    later = stragglers(spark, base, layout, files_by_date(streamed, layout), dates)
    if later:
        parts.append(reader.option("basePath", folder).parquet(*later))
    for name in sorted({d["folder"] for d in dates.values()}):
        held = [k for k, d in dates.items() if d["folder"] == name]
        compacted = spark.read.schema(layout.schema).parquet(f"{compaction_folder(base, layout)}/{name}")
        parts.append(compacted.where(date.isin(*held)))
    out = parts[0].select(*columns)
    for part in parts[1:]:
        out = out.unionByName(part.select(*columns))
    return out
