"""Where bus records come from: Kafka, landed files, or any table of JSON texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import INSTRUMENT_SCHEMA, INSTRUMENTS, KAFKA_SCHEMA, TABLES
from ..settings import StreamOptions
from .compacted import read_laid_out


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int = 5000,
    fail_on_data_loss: bool = False,
    group_id: str | None = None,
) -> dict[str, str]:
    """Checked options of a Kafka stream source for one topic."""
    if not servers or not topic:
        raise ValueError("a Kafka source needs servers and a topic")
    if starting_offsets not in ("latest", "earliest") and not starting_offsets.startswith("{"):
        raise ValueError(f"starting offsets: {starting_offsets!r}")
    if max_offsets_per_trigger <= 0:
        raise ValueError("max_offsets_per_trigger must be positive")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": str(max_offsets_per_trigger),
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        options["kafka.group.id"] = group_id
    return options


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    options: StreamOptions = StreamOptions(),
    **more,
) -> DataFrame:
    """Stream of bus records from Kafka (needs the connector on the class path)."""
    given = kafka_options(
        servers, topic, max_offsets_per_trigger=options.max_offsets_per_trigger, **more
    )
    reader = spark.readStream.format("kafka").options(**given)
    return reader.load().select(*KAFKA_SCHEMA.fieldNames())


def as_records(
    df: DataFrame, value: str = "value", key: str | None = None, topic: str = "events"
) -> DataFrame:
    """Wrap a column of JSON texts into the columns of a bus record.

    Columns the table already has are kept; partition and offset stay NULL
    where nothing stands for them.
    """
    given: dict[str, Column] = {
        "key": F.col(key) if key else F.lit(None),
        "value": F.col(value),
        "topic": F.lit(topic),
    }
    return df.select(
        *[
            given.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in KAFKA_SCHEMA
        ]
    )


def spread_out(df: DataFrame) -> DataFrame:
    """Deal the rows of a source with fewer splits than cores over all cores.

    Judging JSON costs far more than moving it, so a feed that arrives in a
    few unsplittable row groups would leave the cluster idle.  A source with
    enough splits is passed on as it is.  For plain scans: a frame that already
    shuffles would be run to find out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_records(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed bus records as a batch: record files, or text files of JSON lines."""
    if fmt == "text":
        return as_records(spark.read.text(path))
    return spark.read.format(fmt).schema(KAFKA_SCHEMA).load(path)


def stream_records(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: StreamOptions = StreamOptions(),
) -> DataFrame:
    """Landed bus records as a stream, a limited number of files per micro-batch."""
    reader = spark.readStream
    if options.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", options.max_files_per_trigger)
    if fmt == "text":
        return as_records(reader.text(path))
    return reader.format(fmt).schema(KAFKA_SCHEMA).load(path)


def read_letter_lines(spark: SparkSession, path: str) -> DataFrame:
    """Dead-letter files of JSON lines, one line per row."""
    return spark.read.text(path)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One of the output tables, with its fixed schema and partitions by date.

    Dates that have been compacted are read from their clustered files.
    """
    return read_laid_out(spark, base, TABLES[name])


def instruments(spark: SparkSession, rows=INSTRUMENTS) -> DataFrame:
    """The instrument dimension: symbol, company, exchange."""
    return spark.createDataFrame(list(rows), INSTRUMENT_SCHEMA)
