"""Row series for bulk inserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def series(statements: DataFrame, rows: int, id_value: Column | None = None) -> DataFrame:
    """``rows`` new rows ``(id, crt_time)`` for each statement row.

    The number of the row within its statement is available to ``id_value`` as column
    ``n``; by default ids are uniform random numbers below 1e8.
    """
    value = F.rand() * 100_000_000 if id_value is None else id_value
    return statements.select("*", F.explode(F.sequence(F.lit(1), F.lit(rows))).alias("n")).select(
        value.cast("bigint").alias("id"), F.current_timestamp().cast("timestamp_ntz").alias("crt_time")
    )
