"""Session settings the library relies on, and its scratch folders."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Sets what decoding needs; call before reading a stream."""
    # A key repeated in a JSON object keeps its last value.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the shared folder the cluster names in
    ``spark.checkpoint.dir``, or below the warehouse, which every executor reaches anyway,
    where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/telemill/{purpose}-{uuid.uuid4().hex}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder, through the file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A scratch folder that is dropped after use."""
    path = scratch_dir(spark, purpose)
    try:
        yield path
    finally:
        drop_dir(spark, path)
