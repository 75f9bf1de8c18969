"""Incremental Silver and Gold: affected customers are recomputed from all their rows, the rest stays.

Watermarks follow ingest time, one per source table, so late events and tables without new rows are not lost; the
result equals a full rebuild.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.operators.suppression import not_suppressed


def changed_since(df: DataFrame, watermark: float, column: str = "_ingested_at") -> DataFrame:
    return df.where(F.col(column) > watermark)


def affected_customers(*changes: DataFrame) -> DataFrame:
    """Distinct customers of any change."""
    first, *rest = [c.select("customer_id").where("customer_id is not null") for c in changes]
    for c in rest:
        first = first.union(c)
    return first.distinct()


def rebuild(old: DataFrame, sources: DataFrame, affected: DataFrame, build, registry: DataFrame) -> DataFrame:
    """old without the affected customers, plus build() over all rows of the affected ones; suppressed ones go."""
    fresh = build(sources.join(affected, "customer_id", "left_semi").select(*sources.columns))
    kept = not_suppressed(old, registry).join(affected, "customer_id", "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def add_facts(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Facts of new keys are added, known keys stay as they are."""
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns))


def suppressed_skipped(affected: DataFrame, registry: DataFrame) -> int:
    return affected.join(registry.select("customer_id").distinct(), "customer_id", "left_semi").count()


def set_watermark(watermarks: DataFrame, pipeline: str, value: float) -> DataFrame:
    spark = watermarks.sparkSession
    row = spark.createDataFrame([(pipeline, float(value))], "pipeline string, last_ts double")
    return watermarks.where(F.col("pipeline") != pipeline).unionByName(row)


def get_watermark(watermarks: DataFrame, pipeline: str) -> float:
    row = watermarks.where(F.col("pipeline") == pipeline).agg(F.max("last_ts")).first()
    return 0.0 if row[0] is None else float(row[0])
