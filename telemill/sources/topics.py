"""Subscription by topic filter and fan-out to several destinations."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from telemill.functions.names import topic_matches


def subscribe(raw: DataFrame, filters: list[str]) -> DataFrame:
    """Messages whose topic matches any of the filters, each once."""
    return raw.where(reduce(or_, [topic_matches(F.col("topic"), x) for x in filters]))


def fan_out(raw: DataFrame, filters: list[str], mode: str = "matching") -> DataFrame:
    """One row per message and filter, with the filter in ``subscription``.

    ``matching`` sends a message to the filters its topic matches, ``all`` sends every
    message to every filter.
    """
    if mode not in ("matching", "all"):
        raise ValueError(f"unknown fan-out mode: {mode!r}")
    destinations = F.array(
        *[
            F.lit(x) if mode == "all" else F.when(topic_matches(F.col("topic"), x), F.lit(x))
            for x in filters
        ]
    )
    return raw.select("*", F.explode(F.array_compact(destinations)).alias("subscription"))
