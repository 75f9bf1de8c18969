"""The batch pipeline as plain functions called in order; scheduling is left to the user's orchestrator."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.operators import fraud, gold, incremental, privacy, quality, silver, suppression
from glasslake.operators.audit import run_log_row
from glasslake.operators.ordered import parts_of
from glasslake.sources.lake import LAYOUT, Lake
from glasslake.sources.tables import EXPORTABLE, export_lake


def _write_quarantine(lake: Lake, name: str, rows: DataFrame) -> None:
    """Quarantined rows without a customer are a batch of their own, so that they can be renewed alone."""
    lake.write(name, rows.where("customer_id is not null"), placed=True)
    lake.append(name, rows.where("customer_id is null"), NAMELESS)


@contextmanager
def _flagged_orders(lake: Lake, orders: DataFrame, registry: DataFrame) -> Iterator[DataFrame]:
    """Orders deduplicated and flagged once, as a table of the lake, for the three tables that are made from them; it is
    dropped behind them, as it holds what Silver hides."""
    try:
        yield lake.write("silver.flagged_orders", silver.flagged_stored(orders, registry, silver.order_flag), placed=True)
    finally:
        lake.drop("silver.flagged_orders")


def build_silver(lake: Lake, registry: DataFrame) -> dict[str, DataFrame]:
    """Bronze lies by buckets of customers, and so do the rows that are made from it: they are written without a shuffle."""
    payments = silver.flagged_stored(lake.read("bronze.payments"), registry, silver.payment_flag)
    with _flagged_orders(lake, lake.read("bronze.orders"), registry) as orders:
        lake.write("silver.customers", silver.customers_of(orders))
        lake.write("silver.orders", silver.orders_of(orders), placed=True)
        _write_quarantine(lake, "silver.orders_quarantine", silver.bad_orders_of(orders))
    lake.write("silver.payments", silver.payments_of(payments), placed=True)
    _write_quarantine(lake, "silver.payments_quarantine", silver.bad_payments_of(payments))
    return {n: lake.read(n) for n in SILVER}


def build_gold(lake: Lake, registry: DataFrame) -> dict[str, DataFrame]:
    c, o = lake.read("silver.customers"), lake.read("silver.orders")
    alerts = lake.read("bronze.fraud_alerts") if lake.exists("bronze.fraud_alerts") else fraud.all_alerts(lake.read("bronze.payments"), parts=parts_of(lake.read("bronze.payments")), hashed=False)
    people = lake.write("gold.customer_360", gold.customer_360(c, o, registry))  # read again: orders are not summed up twice
    lake.write("gold.order_facts", gold.order_facts(o, people, registry))
    lake.write("gold.fraud_summary", gold.fraud_summary(alerts, registry))
    return {n: lake.read(n) for n in GOLD}


#: What an incremental build reads.
SOURCES = ("bronze.orders", "bronze.payments", "bronze.fraud_alerts")
SILVER = ["silver.customers", "silver.orders", "silver.payments", "silver.orders_quarantine", "silver.payments_quarantine"]
GOLD = ["gold.customer_360", "gold.order_facts", "gold.fraud_summary"]
#: The batch of quarantined rows without a customer.
NAMELESS = "nameless"


def pending(lake: Lake, pipeline: str = "incremental") -> dict[str, list[str]]:
    """Batches of each source that no build of the pipeline has taken in.

    Batches are compared by name and not by time: one that is shown late, or whose events are old, is still new.
    """
    done: set[tuple[str, str]] = set()
    if lake.exists("governance.processed_batches"):
        rows = lake.read("governance.processed_batches").where(F.col("pipeline") == pipeline).select("table_name", "batch").distinct()
        done = {tuple(r) for r in rows.collect()}  # one row for each batch, as the partitions that a scan lists
    return {n: [b for b in lake.batches(n) if (n, b) not in done] for n in SOURCES if lake.exists(n)}


def mark_processed(lake: Lake, batches: dict[str, list[str]], pipeline: str = "incremental") -> None:
    """Added rows, never rewritten ones: builds and streams that mark at the same time do not undo each other."""
    rows = [(pipeline, n, b) for n, found in batches.items() for b in found]
    if rows:
        lake.append("governance.processed_batches", lake.spark.createDataFrame(rows, "pipeline string, table_name string, batch string"))


def new_rows(lake: Lake, name: str, batches: list[str]) -> DataFrame:
    """Rows of some batches: the folders of the others are not read."""
    return lake.stored(name).where(F.col("_batch").isin(batches)).drop(*LAYOUT)


def build_incremental(lake: Lake, registry: DataFrame) -> dict[str, int]:
    """Silver and Gold brought up to date: customers with rows in new batches are recomputed from all their rows.

    New rows are read by their batches, the rows of the affected customers by their buckets, and only those buckets of
    Silver and Gold are written again. Customers too many to be broadcast are not picked out of their buckets by shuffles of
    whole tables: all customers of these buckets are recomputed then, to the same rows. Equal to a full build. Returns how many customers were recomputed and how many of
    them are suppressed.
    """
    fresh = pending(lake)
    changed = [new_rows(lake, n, batches).select("customer_id") for n, batches in fresh.items()]
    # whoever was suppressed since the last build leaves Silver and Gold even without new rows
    gone = [lake.of_customers(n, registry).select("customer_id") for n in ("silver.customers", "silver.orders", "silver.payments", *GOLD)]
    # written, as Silver and Gold change below
    affected = lake.write("silver.affected_customers", incremental.affected_customers(*changed, *gone))
    whole = affected.limit(suppression.BROADCAST_ROWS + 1).count() > suppression.BROADCAST_ROWS
    buckets = [r[0] for r in affected.select(lake.bucket().alias("b")).distinct().collect()]  # bounded by the buckets
    mine = lambda name: (lake.in_buckets(name, buckets) if whole else lake.of_customers(name, affected)).drop(*LAYOUT)
    renew = lambda name, rows, placed=False: lake.replace_customers(name, affected, rows, placed, whole)
    payments = mine("bronze.payments")
    p = silver.flagged_stored(payments, registry, silver.payment_flag)
    with _flagged_orders(lake, mine("bronze.orders"), registry) as o:
        renew("silver.customers", silver.customers_of(o))
        renew("silver.orders", silver.orders_of(o), True)
        renew("silver.orders_quarantine", silver.bad_orders_of(o), True)
    renew("silver.payments", silver.payments_of(p), True)
    renew("silver.payments_quarantine", silver.bad_payments_of(p), True)
    for source, target, build in (("bronze.orders", "silver.orders_quarantine", silver.orders_quarantine), ("bronze.payments", "silver.payments_quarantine", silver.payments_quarantine)):
        if not new_rows(lake, source, fresh[source]).where("customer_id is null").isEmpty():
            lake.append(target, build(lake.read(source).where("customer_id is null"), registry), NAMELESS)
    c, o = mine("silver.customers"), mine("silver.orders")
    people = renew("gold.customer_360", gold.customer_360(c, o, registry))
    renew("gold.order_facts", gold.order_facts(o, people, registry))
    alerts = mine("bronze.fraud_alerts") if lake.exists("bronze.fraud_alerts") else fraud.all_alerts(payments, parts=parts_of(payments) if whole else None, hashed=False)
    renew("gold.fraud_summary", gold.fraud_summary(alerts, registry))
    mark_processed(lake, fresh)
    out = {"affected": affected.count(), "suppressed": incremental.suppressed_skipped(affected, registry)}
    lake.drop("silver.affected_customers")
    return out


def check_quality(lake: Lake, registry: DataFrame, run_id: str, now: float) -> DataFrame:
    t = {n: lake.read(n) for n in EXPORTABLE}
    checks = {
        "unique": lambda: quality.uniqueness(t["silver.customers"], "customer_id", "silver.customers"),
        "pii": lambda: quality.pii_not_clear(t["silver.customers"], ["email_hash", "iban_hash"], "silver.customers"),
        "consent": lambda: quality.consent_mirror(t["gold.customer_360"], "gold.customer_360"),
        "orphans": lambda: quality.referential(t["gold.order_facts"], t["gold.customer_360"], "customer_id", "gold.order_facts"),
        "suppression": lambda: quality.suppression_enforced(t, registry),
        "anonymity": lambda: quality.k_anonymity(t["silver.customers"], ["country", "marketing_consent"], "silver.customers"),
    }
    found = quality.run_checks(lake.spark, checks, run_id, now)
    lake.append("governance.quality_results", found)
    return found


def run_pipeline(lake: Lake, registry: DataFrame, export_to: Lake | None = None, run_id: str = "run", now: float | None = None, incremental_build: bool = False) -> list[str]:
    """Personal-data gate, Silver, Gold, quality, export: stops at the first failure, after one retry.

    incremental_build recomputes only customers with new rows, once a full build is there.
    """
    now = time.time() if now is None else now
    done: list[str] = []
    built = all(lake.exists(n) for n in (*EXPORTABLE, "silver.orders_quarantine", "silver.payments_quarantine"))
    batches = {n: lake.batches(n) for n in SOURCES if lake.exists(n)}  # before anything is read: later ones stay pending

    def gate_pii() -> None:
        bronze = lake.read("bronze.orders")
        if lake.exists("governance.pii_manifest"):
            if not privacy.detect_unregistered(bronze, "bronze.orders", lake.read("governance.pii_manifest")).isEmpty():
                raise quality.QualityGateError("unregistered personal data")
        else:
            lake.write("governance.pii_manifest", privacy.build_manifest(bronze, "bronze.orders"))

    def export() -> None:
        if export_to is not None:
            export_lake({n: lake.read(n) for n in EXPORTABLE}, export_to)

    build = (
        [("incremental", lambda: build_incremental(lake, registry), list(SOURCES), SILVER + GOLD)]
        if incremental_build and built
        else [("silver", lambda: build_silver(lake, registry), ["bronze.orders", "bronze.payments"], SILVER), ("gold", lambda: build_gold(lake, registry), ["silver.customers", "silver.orders", "bronze.payments"], GOLD)]
    )
    tasks = [
        ("pii", gate_pii, ["bronze.orders"], ["governance.pii_manifest"]), *build,
        ("quality", lambda: quality.gate(check_quality(lake, registry, run_id, now)), list(EXPORTABLE), ["governance.quality_results"]), ("export", export, list(EXPORTABLE), list(EXPORTABLE) if export_to else []),
    ]
    for name, task, inputs, outputs in tasks:
        started = time.time()
        log = lambda status, rows: lake.append("governance.run_log", run_log_row(lake.spark, name, inputs, outputs, started, time.time(), status, rows))  # noqa: B023, E731
        for attempt in (1, 2):
            try:
                task()
                break
            except quality.QualityGateError:
                log("failed", {})
                raise
            except Exception:
                if attempt == 2:
                    log("failed", {})
                    raise
        at = export_to if name == "export" else lake
        log("completed", {n: at.read(n).count() for n in outputs})
        done.append(name)
    if not (incremental_build and built):
        known = pending(lake)
        mark_processed(lake, {n: [b for b in found if b in known.get(n, [])] for n, found in batches.items()})
    return done


def counts(lake: Lake, names: list[str]) -> DataFrame:
    from glasslake.operators.reports import table_counts

    return table_counts({n: lake.read(n) for n in names}).orderBy(F.col("table_name"))
