"""Writes by key, snapshots and exports as DataFrame operators; `lake.py` keeps the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.sources.lake import Lake, SinkMismatch, first_per_key


def merge_alerts(target: DataFrame, batch: DataFrame, registry: DataFrame) -> DataFrame:
    """Upsert by alert_id: a newer or equally new alert replaces the stored one; suppressed customers stay out."""
    incoming = first_per_key(batch.join(registry.select("customer_id").distinct(), "customer_id", "left_anti"), "alert_id", [F.desc("alerted_at"), F.col("event_id")])
    both = target.withColumn("__new", F.lit(0)).unionByName(incoming.select(*target.columns).withColumn("__new", F.lit(1)))
    return first_per_key(both, "alert_id", [F.desc("alerted_at"), F.desc("__new")]).drop("__new")


def upsert_alerts(lake: Lake, name: str, batch: DataFrame, registry: DataFrame, batch_name: str | None = None) -> None:
    """merge_alerts on a stored table: new alerts are a batch of their own, newer forms of stored ones take their place."""
    if not lake.exists(name):
        lake.append(name, merge_alerts(batch.limit(0), batch, registry), batch_name)
        return
    incoming = batch.join(registry.select("customer_id").distinct(), "customer_id", "left_anti").select(*batch.columns)
    lake.replace_using(name, incoming, "alert_id", [F.desc("alerted_at"), F.col("event_id")], batch_name)


def fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Row count and an order-free content checksum; nulls and column names count."""
    row = F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}))
    return df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(F.pmod(row, F.lit(1_000_000_007))), F.lit(0)).alias("checksum"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("mixed")).select(F.lit(name).alias("table_name"), "row_count", "checksum", "mixed")


def snapshot_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [fingerprint(df, name) for name, df in tables.items()])


def reconcile(primary: dict[str, DataFrame], copy: dict[str, DataFrame]) -> DataFrame:
    """table_name, rows on both sides, and whether contents agree; a table missing on one side does not."""
    return verify_snapshot(snapshot_manifest(primary), snapshot_manifest(copy))


def verify_snapshot(expected: DataFrame, found: DataFrame) -> DataFrame:
    a, b = expected.alias("a"), found.alias("b")
    both = a.join(b, F.col("a.table_name") == F.col("b.table_name"), "full_outer")
    same = F.coalesce((F.col("a.row_count") == F.col("b.row_count")) & (F.col("a.checksum") == F.col("b.checksum")) & (F.col("a.mixed") == F.col("b.mixed")), F.lit(False))
    return both.select(F.coalesce("a.table_name", "b.table_name").alias("table_name"), F.col("a.row_count").alias("rows_primary"), F.col("b.row_count").alias("rows_copy"), same.alias("matches"))


#: The tables that may leave the lake, all without clear personal data.
EXPORTABLE = ("silver.customers", "silver.orders", "silver.payments", "gold.customer_360", "gold.order_facts", "gold.fraud_summary")


def export_lake(tables: dict[str, DataFrame], out: Lake) -> DataFrame:
    """Write all tables to the staging area of the export, verify count and schema of each copy, and then replace the
    exported ones from there; the staged copies go."""
    for name in tables:
        if name not in EXPORTABLE:
            raise ValueError(f"{name} may not be exported")
    staged = {name: name.replace(".", "_staged.") for name in tables}
    for name, df in tables.items():
        out.write(staged[name], df)
        back = out.read(staged[name])
        types = lambda d: sorted((f.name, f.dataType.simpleString()) for f in d.schema.fields)
        if types(back) != types(df) or back.count() != df.count():
            raise SinkMismatch(f"staged copy of {name} differs")
    for name in tables:
        out.copy(name, staged[name])
    report = verify_export(out, {name: out.read(staged[name]) for name in tables})
    passed = {r["table_name"]: r["row_count"] for r in report.where("passed").collect()}  # one row for each exported table
    for name in tables:
        out.drop(staged[name])
        if name not in passed:
            raise SinkMismatch(f"exported copy of {name} differs")
    return out.spark.createDataFrame([(n, c, True) for n, c in passed.items()], report.schema)


def verify_export(out: Lake, tables: dict[str, DataFrame], erased: DataFrame | None = None) -> DataFrame:
    """table_name, row_count, passed: the exported copy equals its source and holds no erased customer."""
    parts = []
    for name, df in tables.items():
        back = out.read(name)
        lost = back.join(erased.select("customer_id").distinct(), "customer_id", "left_semi").agg(F.count("*").alias("bad")) if erased is not None else out.spark.range(1).select(F.lit(0).alias("bad"))
        both = back.agg(F.count("*").alias("row_count")).crossJoin(df.agg(F.count("*").alias("want"))).crossJoin(lost)  # one-row aggregates
        parts.append(both.select(F.lit(name).alias("table_name"), "row_count", ((F.col("row_count") == F.col("want")) & (F.col("bad") == 0)).alias("passed")))
    return reduce(DataFrame.unionByName, parts)


def seed_from_lake(store: Lake, snapshot: Lake, names: list[str], registry: DataFrame) -> list[str]:
    """Fill empty tables from a snapshot, without suppressed customers; the tables filled."""
    filled = []
    for name in names:
        if not store.exists(name) or store.read(name).isEmpty():
            store.write(name, snapshot.read(name).join(registry.select("customer_id").distinct(), "customer_id", "left_anti"))
            filled.append(name)
    return filled


def read_bronze(store: Lake, name: str, limit: int | None = None) -> DataFrame:
    if name not in ("orders", "clicks", "payments", "fraud_alerts", "erasure_requests", "ingest_quarantine"):
        raise ValueError(f"unknown Bronze table {name!r}")
    df = store.read(f"bronze.{name}")
    return df if limit is None else df.limit(limit)
