"""What several operators need: the documents, staged tables, digests, work on Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from telemill.session import drop_dir, scratch_dir

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def reachable(spark: SparkSession) -> None:
    """Lets Python workers import this library where the driver found it by its own path only."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        environment["PYTHONPATH"] = f"{known}:{ROOT}".lstrip(":")


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Drops, at its end, the tables that were staged within. What is still to be read later is
    written elsewhere before."""
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            drop_dir(spark, path)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once as Parquet to the shared folder and read again: they are computed
    once, a lost executor costs no second pass, and a join sees a plain scan on this side, which
    is what lets adaptive execution split a hot key."""
    path = scratch_dir(df.sparkSession, f"llm-{purpose}")
    if (made := _scratch.get()) is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def pick(df: DataFrame, **named: Column) -> DataFrame:
    """Only the named columns; what else the table has cannot clash with names used inside."""
    return df.select(*(column.alias(name) for name, column in named.items()))


def whole(text: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def mapped(
    df: DataFrame,
    work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow`` with workers that can import this library."""
    reachable(df.sparkSession)
    return df.mapInArrow(work, schema)


def temporary() -> str:
    """A column name no table has."""
    return f"tm_{uuid.uuid4().hex}"
