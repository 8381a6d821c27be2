"""Writing the output tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import TABLES, TableLayout
from ..sources.compacted import exists

BatchWriter = Callable[[DataFrame, int], None]


def ensure_table(spark: SparkSession, layout: TableLayout, base: str, name: str | None = None):
    """Create the table over ``base`` if it is missing: by-date partitions, fixed columns."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        for f in layout.schema
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name or layout.name} ({columns}) USING parquet "
        f"PARTITIONED BY ({layout.partition_by}) LOCATION '{base}/{layout.name}'"
    )


def laid_out(df: DataFrame, layout: TableLayout) -> DataFrame:
    """Arrange rows for the files of a table.

    Ranges over date, cluster columns and a unique tail put neighbours into
    the same few files, yet no date or symbol is too hot to be cut.  Tables
    without such a tail are only sorted where they are.
    """
    present = [c for c in layout.cluster_by if c in df.columns]
    tail = [c for c in layout.spread_by if c in df.columns]
    if tail:
        df = df.repartitionByRange(layout.partition_by, *present, *tail)
    return df.sortWithinPartitions(layout.partition_by, *present)


def append_table(df: DataFrame, base: str, layout: TableLayout, fmt: str = "parquet") -> None:
    """Append a batch to a table, partitioned by date where it has one.

    A folder that Spark's file sink has streamed into is refused: readers go by
    the sink's own log there and would not see the new rows.
    """
    if exists(df.sparkSession, f"{base}/{layout.name}/_spark_metadata"):
        raise ValueError(f"{base}/{layout.name} belongs to a stream; append to another folder")
    writer = laid_out(df, layout).write.format(fmt).mode("append")
    if layout.partition_by in df.columns:
        writer = writer.partitionBy(layout.partition_by)
    writer.save(f"{base}/{layout.name}")


def rows_by_date(df: DataFrame, layout: TableLayout) -> dict:
    return {r[0]: r[1] for r in df.groupBy(layout.partition_by).count().collect()}


def clustered(df: DataFrame, layout: TableLayout, dates: dict, file_rows: int) -> DataFrame:
    """Rows in a sorted range per ``file_rows`` rows, about; ``dates`` as by `rows_by_date`.

    A date of up to ``file_rows`` rows is never cut; a larger one is cut over the cluster
    columns, with a tail (of its own or a hash of the row) that keeps a hot value splittable.
    """
    files = max(1, -(-sum(dates.values()) // file_rows))
    order = [layout.partition_by, *layout.cluster_by]
    tail = [F.col(c) for c in layout.spread_by] or [F.xxhash64(*df.columns)]
    large = F.lit(False)
    for date in [d for d, n in dates.items() if n > file_rows]:
        large = large | F.col(layout.partition_by).eqNullSafe(F.lit(date))
    within = [F.when(large, c) for c in (*map(F.col, layout.cluster_by), *tail)]
    return df.repartitionByRange(files, layout.partition_by, *within).sortWithinPartitions(*order)


def parquet_batches(
    base: str,
    layout: TableLayout,
    fmt: str = "parquet",
    checkpoint: str | None = None,
    table: str | None = None,
    file_rows: int = 1_000_000,
    **options,
) -> BatchWriter:
    """A per-batch writer that may be run again for the same batch.

    Every micro-batch owns the folder ``query_id=<id>/batch_id=<n>`` and replaces
    it whole, so a batch repeated after a failure leaves the same rows, not twice
    as many.  The query's id is kept in its checkpoint: a query with another
    checkpoint counts from batch 0 again, but in folders of its own.

    A batch is clustered into a file per ``file_rows`` rows and date; an empty one writes
    none.  With ``table`` the table of that name is created over ``base`` if need be.
    Last of all the batch is entered in the log of commits (`read_commits`), again
    under its own name: rows without an entry are of a batch that will be repeated.
    """
    known: list[str] = []

    def query_id(spark: SparkSession) -> str:
        if not known:
            text = spark.read.text(f"{checkpoint}/metadata").first() if checkpoint else None
            known.append(json.loads(text[0])["id"] if text else "none")
        return known[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if table:
            ensure_table(spark, layout, base, table)
        place = f"query_id={query_id(spark)}/batch_id={batch_id}"
        batch = batch.persist()  # counted, sampled and written, but computed once
        try:
            dates = rows_by_date(batch, layout)
            rows = sum(dates.values())
            if rows:
                laid = clustered(batch, layout, dates, file_rows)
                writer = laid.write.format(fmt).options(**options).mode("overwrite")
                if layout.partition_by in batch.columns:
                    writer = writer.partitionBy(layout.partition_by)
                writer.save(f"{base}/{layout.name}/{place}")
        finally:
            batch.unpersist()
        entry = spark.range(1).select(F.lit(rows).cast("long").alias("rows"), F.current_timestamp().alias("at"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{_commits(base, layout)}/{place}")

    return write


def _commits(base: str, layout: TableLayout) -> str:
    return f"{base}/_commits/{layout.name}"


def read_commits(spark: SparkSession, base: str, layout: TableLayout) -> DataFrame:
    """``(query_id, batch_id, rows, at)`` of every batch a per-batch writer has finished."""
    schema = "rows long, at timestamp, query_id string, batch_id long"
    return spark.read.schema(schema).parquet(_commits(base, layout)).select("query_id", "batch_id", "rows", "at")


def console_batches(base: str, layout: TableLayout, rows: int = 20) -> BatchWriter:
    """A per-batch writer that prints the first rows of every non-empty batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            print(f"{layout.name}, batch {batch_id}")
            batch.show(rows, truncate=False)

    return write


_WRITERS: dict[str, Callable[..., BatchWriter]] = {
    "table": parquet_batches,
    "console": console_batches,
}


def batch_writer(kind: str, base: str, layout: TableLayout, **options) -> BatchWriter:
    """The per-batch writer of that name."""
    if kind not in _WRITERS:
        raise ValueError(f"unknown sink {kind!r}; known: {', '.join(sorted(_WRITERS))}, parquet")
    return _WRITERS[kind](base, layout, **options)


def write_tables(tables: dict[str, DataFrame], base: str) -> None:
    """Append each named batch frame to its table."""
    for name, df in tables.items():
        append_table(df, base, TABLES[name])


def write_report(report: DataFrame, folder: str) -> None:
    """Append a report to a folder of JSON files, stamped with its time."""
    report.withColumn("generated_at", F.current_timestamp()).write.mode("append").json(folder)
