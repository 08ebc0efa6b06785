"""Raw snapshots of one or more feeds, from archived files or a message topic."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docklake.functions import text

# A parser maps the content to (snapshot time in ms, key); a null in either rejects the snapshot.
SnapshotParser = Callable[[Column], tuple[Column, Column]]

PARSERS: dict[str, SnapshotParser] = {
    "updatetime": lambda content: (text.updatetime_millis(content), text.content_key(content)),
    "updatetime_random_key": lambda content: (text.updatetime_millis(content), F.uuid()),
}


def register_parser(name: str, parser: SnapshotParser) -> None:
    PARSERS[name] = parser


@dataclass(frozen=True)
class Feed:
    datasource: str
    path: str
    parser: str = "updatetime"


def tag_snapshots(contents: DataFrame, datasource: str, parser: str = "updatetime") -> DataFrame:
    """Raw snapshot rows of a frame with a ``content`` column; other columns are kept."""
    timestamp_ms, key = PARSERS[parser](F.col("content"))
    return contents.select(
        F.lit(datasource).alias("datasource"),
        timestamp_ms.alias("timestamp_ms"),
        key.alias("key"),
        *contents.columns,
    )


def readable(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("timestamp_ms").isNotNull() & F.col("key").isNotNull())


def unreadable(raw: DataFrame) -> DataFrame:
    """What the parser could not date or key; kept aside instead of being lost."""
    return raw.where(F.col("timestamp_ms").isNull() | F.col("key").isNull())


def snapshot_files(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Archived documents as (path, content). With ``limit`` only the first ones in path order: the paths are listed
    without content, and only the chosen documents are read."""
    chosen: str | list[str] = path
    if limit is not None:
        listed = spark.read.format("binaryFile").load(path).select("path").orderBy("path").limit(limit)
        chosen = [row["path"] for row in listed.collect()]
        if not chosen:
            return spark.createDataFrame([], "path string, content string")
    return spark.read.text(chosen, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def snapshot_file_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """The same as a stream, oldest files first, with bounded micro-batches."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("arrival"),
        F.col("value").alias("content"),
    )


def message_stream(
    spark: SparkSession, topics: str, servers: str, max_messages: int = 100_000, **options: str
) -> DataFrame:
    """Messages (topic, key, content, arrival) of a Kafka topic; needs the Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("maxOffsetsPerTrigger", max_messages)
    )
    for name, value in options.items():
        reader = reader.option(name.replace("__", "."), value)
    return message_columns(reader.load())


def message_columns(messages: DataFrame) -> DataFrame:
    """What is used of the columns a topic's reader gives: (topic, key, value as bytes, timestamp, ...)."""
    return messages.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("content"),
        F.col("timestamp").alias("arrival"),
    )


def check_feeds(feeds: Iterable[Feed]) -> list[Feed]:
    feeds = list(feeds)
    names = [feed.datasource for feed in feeds]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"datasource configured more than once: {', '.join(repeated)}")
    unknown = sorted({feed.parser for feed in feeds} - set(PARSERS))
    if unknown:
        raise ValueError(f"unknown snapshot parser: {', '.join(unknown)}")
    return feeds


def read_feeds(spark: SparkSession, feeds: Iterable[Feed]) -> DataFrame:
    """Archived snapshots of several feeds side by side, tagged by datasource."""
    frames = [tag_snapshots(snapshot_files(spark, f.path), f.datasource, f.parser) for f in check_feeds(feeds)]
    return reduce(DataFrame.unionByName, frames)
