"""Flattening of nested event arrays to one JSON line each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_events(items: DataFrame, events: str = "events") -> DataFrame:
    """A row for each event of each item, with ``line`` as JSON; a missing or empty array gives none."""
    each = items.select(F.explode(events).alias("e"))
    line = F.to_json(F.struct(F.col("e.timestamp").alias("timestamp"), F.col("e.channel").alias("channel"), F.col("e.message").alias("event")), {"ignoreNullFields": "false"})
    return each.select(F.col("e.timestamp").alias("timestamp"), F.col("e.channel").alias("channel"), F.col("e.message").alias("event"), line.alias("line"))
