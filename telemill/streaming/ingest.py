"""Continuous ingest: micro-batches of a raw stream through the same load as a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from telemill.options import Options
from telemill.plans.load import LoadReport, check_name, load
from telemill.plans.parse import DEFAULT_PARSER
from telemill.session import configure


def batch_name(stream: str, query_id: str, batch_id: int) -> str:
    """Batch numbers begin at 0 again with every checkpoint; the query's id, which lives in
    the checkpoint, tells them apart."""
    return f"{stream}-{query_id}-{batch_id:012d}"


def backlog(query: StreamingQuery) -> dict[str, int]:
    """What waits in the landing folder, as the last micro-batch left it: files and bytes
    for sources that count them."""
    sources = (query.lastProgress or {}).get("sources", [])
    waiting: dict[str, int] = {}
    for source in sources:
        for name, value in (source.get("metrics") or {}).items():
            if name.endswith("Outstanding"):
                waiting[name] = waiting.get(name, 0) + int(value)
    return waiting


def start_ingest(
    raw: DataFrame,
    stream: str,
    checkpoint: str,
    options: Options | None = None,
    parser: str = DEFAULT_PARSER,
    trigger: dict | None = None,
    on_batch: Callable[[LoadReport], None] | None = None,
) -> StreamingQuery:
    """Starts the ingest of a raw stream.

    Each micro-batch is one load named after the stream, the checkpoint and the batch. A
    batch that is replayed after a failure has the same name, so it replaces its own rows
    and leaves no duplicates; a new checkpoint has new names and replaces nothing. Outcomes
    for a table that cannot take them are parked, so the stream goes on.
    """
    configure(raw.sparkSession)
    check_name(batch_name(stream, "0" * 36, 0))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        # A micro-batch may be of a file or two, each read by few tasks.
        report = load(batch, batch_name(stream, query_id, batch_id), options, parser, spread=True)
        if on_batch is not None:
            on_batch(report)

    return (
        raw.writeStream.queryName(stream)
        .foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
