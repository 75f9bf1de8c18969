"""Keeping erased customers out: the anti-join against the suppression registry."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registry rows up to which the anti-join broadcasts it (a row is some 40 bytes); larger ones are shuffled.
BROADCAST_ROWS = 1_000_000


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df marked for broadcast if it is proven to hold at most so many rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Registries sized so far: one look per registry, however many tables it is taken out of.
_SIZED: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()


def suppressed_ids(registry: DataFrame) -> DataFrame:
    """The registry's distinct customers, marked for broadcast if proven small; a stream reads its registry anew per batch."""
    if registry not in _SIZED:
        _SIZED[registry] = sized(registry.select("customer_id").distinct())
    return _SIZED[registry]


def not_suppressed(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows whose customer is not in the registry; a NULL customer stays. Works on streams too (static registry)."""
    return df.join(suppressed_ids(registry), "customer_id", "left_anti").select(*df.columns)


def leaks(df: DataFrame, registry: DataFrame) -> DataFrame:
    return df.join(registry.select("customer_id").distinct(), "customer_id", "left_semi")


def suppress(registry: DataFrame, requests: DataFrame) -> DataFrame:
    """The registry with new customers added; the first added_at stays."""
    both = registry.select("customer_id", "added_at").unionByName(requests.select("customer_id", "added_at"))
    return both.where("customer_id is not null").groupBy("customer_id").agg(F.min("added_at").alias("added_at"))
