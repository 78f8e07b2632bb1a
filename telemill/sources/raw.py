"""Raw messages ``(seq, topic, payload, recv_ts)``, as a batch or as a stream.

``seq`` is the arrival order within a load; it must be unique and must not change when
the same input is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

RAW_COLUMNS = ("seq", "topic", "payload", "recv_ts")
RAW_SCHEMA = "seq BIGINT, topic STRING, payload STRING, recv_ts TIMESTAMP_NTZ"


def as_raw(
    df: DataFrame,
    seq: str = "seq",
    topic: str = "topic",
    payload: str = "payload",
    recv_ts: str = "recv_ts",
) -> DataFrame:
    """Raw messages from any DataFrame with these four columns. A binary payload keeps
    its bytes; whether they are UTF-8 is decided when decoding."""
    return df.select(
        F.col(seq).cast("bigint").alias("seq"),
        F.col(topic).cast("string").alias("topic"),
        F.col(payload).cast("string").alias("payload"),
        F.col(recv_ts).cast("timestamp_ntz").alias("recv_ts"),
    )


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", **columns: str) -> DataFrame:
    """All messages of a landing folder."""
    if fmt == "text":
        return numbered(_lines(spark.read.format("text").option("lineSep", "\n").load(path)))
    return as_raw(spark.read.schema(_schema(columns)).format(fmt).load(path), **columns)


def stream_raw(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    **columns: str,
) -> DataFrame:
    """Messages of a landing folder as files arrive. The two limits bound a micro-batch,
    so a backlog waits in the folder instead of growing a queue. Lines of text files have a
    ``place`` instead of a number; a load numbers them per micro-batch (see ``numbered``)."""
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if fmt == "text":
        return _lines(reader.option("lineSep", "\n").load(path))
    return as_raw(reader.schema(_schema(columns)).load(path), **columns)


def _schema(columns: dict[str, str]) -> StructType:
    schema = StructType.fromDDL(RAW_SCHEMA)
    for field in schema.fields:
        field.name = columns.get(field.name, field.name)
    return StructType(schema.fields)


#: Splits of text files (40 bytes each) whose first numbers are broadcast; more are shuffled.
BROADCAST_SPLITS = 1 << 20


def _lines(text: DataFrame) -> DataFrame:
    """One payload per line; the folder a file lies in is its topic. ``place`` is the split of a file
    that a line was read with."""
    path, time = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    return text.select(
        F.struct(path.alias("file"), F.col("_metadata.file_block_start").alias("block")).alias("place"),
        F.regexp_extract(path, "([^/]*)/[^/]*$", 1).alias("topic"),
        F.regexp_replace("value", "\\r$", "").alias("payload"),
        time.cast("timestamp_ntz").alias("recv_ts"),
    )


def numbered(lines: DataFrame) -> DataFrame:
    """Raw messages from lines with a ``place``; other raw messages as they are.

    ``seq`` counts the lines from 0, files in the order of their paths, lines in their own order.
    The lines of each split are counted first, without their text, so a large file is read by many
    tasks, and neither their number nor the size of the splits changes the numbers.
    """
    if "place" not in lines.columns:
        return lines
    # A task reads a split whole, and its count goes on from split to split.
    lines = lines.withColumn("at", F.monotonically_increasing_id())
    splits = lines.groupBy("place").agg(F.min("at").alias("first"), F.count("*").alias("lines"))
    # One row per split.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("start", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    starts = starts.select(
        F.xxhash64("place.file").alias("file"), F.col("place.block").alias("block"), F.shiftright("first", 33).alias("task"),
        (F.col("start") - F.col("first")).alias("ahead"),
    )
    placed = lines.withColumns({"file": F.xxhash64("place.file"), "block": F.col("place.block"), "task": F.shiftright("at", 33)})
    few = splits.count() <= BROADCAST_SPLITS
    joined = placed.join(F.broadcast(starts) if few else starts, ["file", "block", "task"])
    return joined.select((F.col("at") + F.col("ahead")).alias("seq"), "topic", "payload", "recv_ts")
