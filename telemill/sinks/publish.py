"""Outgoing messages: every row as JSON, to every topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def publish(rows: DataFrame, topics: list[str]) -> DataFrame:
    """``(topic, payload)``, one per row and topic. Columns that are NULL are kept as
    JSON nulls. The result can go to any sink with these two columns."""
    payload = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return rows.select(payload.alias("payload")).select(
        F.explode(F.array(*[F.lit(topic) for topic in topics])).alias("topic"), "payload"
    )


def write_messages(
    messages: DataFrame, path: str, fmt: str = "json", checkpoint: str | None = None
) -> StreamingQuery | None:
    """Appends outgoing messages to a folder a bridge picks up. A stream of them needs a
    checkpoint; the query that writes what has arrived is returned."""
    if not messages.isStreaming:
        messages.write.mode("append").format(fmt).save(path)
        return None
    if checkpoint is None:
        raise ValueError("a stream of messages needs a checkpoint")
    writer = messages.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
