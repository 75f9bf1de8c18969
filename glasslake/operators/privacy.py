"""Finding personal data in columns and free text, and masked views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.functions.scalars import EMAIL, IBAN, IPV4, PHONE, classify_value


def column_tags(df: DataFrame, table: str) -> DataFrame:
    """table_name, column_name, tag, hits, total over every row: one pass, partial counts before the shuffle."""
    columns = [c for c in df.columns if not c.startswith("_")]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])
    long = df.select(F.explode(pairs).alias("p")).select("p.*").where("v is not null")
    tagged = long.select("column_name", F.explode_outer(classify_value("v")).alias("tag"))
    counts = tagged.groupBy("column_name", "tag").agg(F.count("*").alias("hits"))
    totals = long.groupBy("column_name").agg(F.count("*").alias("total"))
    return counts.where("tag is not null").join(totals, "column_name").withColumn("table_name", F.lit(table))


def classify_columns(df: DataFrame, table: str, threshold: float = 0.6) -> DataFrame:
    found = column_tags(df, table).where(F.col("hits") >= threshold * F.col("total"))
    return found.groupBy("table_name", "column_name").agg(F.array_sort(F.collect_set("tag")).alias("pii_tags"))


def build_manifest(df: DataFrame, table: str) -> DataFrame:
    """Any hit in any row tags the column."""
    return column_tags(df, table).groupBy("table_name", "column_name").agg(F.array_sort(F.collect_set("tag")).alias("pii_tags"))


def detect_unregistered(df: DataFrame, table: str, manifest: DataFrame) -> DataFrame:
    """Columns whose tags do not meet the registered ones; a first run (empty manifest) registers instead."""
    found = build_manifest(df, table).withColumnRenamed("pii_tags", "detected")
    both = found.join(manifest.withColumnRenamed("pii_tags", "registered"), ["table_name", "column_name"], "left")
    return both.where(~F.coalesce(F.arrays_overlap("detected", "registered"), F.lit(False)))


def free_text_pii(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Finds of each pattern per document with any; the patterns are searched, not matched."""
    counts = {"emails": rf"({EMAIL})", "ips": rf"\b({IPV4})\b", "phones": r"(\+\d[\d\s().-]{7,})", "ibans": rf"\b({IBAN})\b"}
    found = df.select(key, *[F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(p), F.lit(1))).alias(n) for n, p in counts.items()])
    return found.where(reduce(lambda a, b: a | b, [F.col(n) > 0 for n in counts]))


def masked_view(df: DataFrame, columns: list[str], allowed: bool, restricted: str | None = None) -> DataFrame:
    """Columns readable only where allowed; rows under the restricted condition hidden otherwise."""
    out = df if allowed else df.withColumns({c: F.lit("<masked>") for c in columns})
    return out.where(~F.coalesce(F.expr(restricted), F.lit(False))) if restricted and not allowed else out
