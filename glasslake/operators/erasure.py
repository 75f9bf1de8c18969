"""Erasure of a set of customers: masks, deletions, proofs, and the state of each command.

Everything takes a set of requests and joins it to each table once, so the cost is one pass per table and not one
per customer. On stored tables only the partitions that hold the customers are read and written again (lake.py).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasslake.functions.scalars import MASK, confirmation_hash
from glasslake.operators.payloads import rows_of, without_customers
from glasslake.operators.suppression import suppress

#: Personal columns of each Bronze table.
PII = {"bronze.orders": ["email", "iban"], "bronze.payments": ["iban"], "bronze.clicks": ["ip_address"]}
DELETED = (
    "silver.customers", "silver.orders", "silver.payments", "silver.orders_quarantine", "silver.payments_quarantine", "silver.affected_customers", "silver.flagged_orders", "gold.customer_360", "gold.order_facts", "gold.fraud_summary",
    "bronze.fraud_alerts", "bronze.late_events", "bronze.erasure_requests",
)
#: Tables whose payload is kept as it came: rows of a customer are found by id or inside the payload.
PAYLOADS = ("bronze.ingest_quarantine", "governance.dead_letters")
#: Tables that prove the erasure, or hold nothing about a customer.
KEPT = (
    "governance.suppression_registry", "governance.erasure_audit_log", "governance.erasure_audit_chain", "governance.erasure_command_state", "governance.quality_results",
    "governance.pii_manifest", "governance.watermarks", "governance.processed_batches", "governance.run_log", "governance.contracts",
)


def _ids(requests: DataFrame) -> DataFrame:
    return requests.where("customer_id is not null").select("customer_id").distinct()


def mask(df: DataFrame, requests: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of the requested customers replaced by the marker; one left join, all rows kept."""
    hit = df.join(_ids(requests).withColumn("__hit", F.lit(True)), "customer_id", "left")
    return hit.withColumns({c: F.when(F.col("__hit"), F.lit(MASK)).otherwise(F.col(c)) for c in columns}).select(*df.columns)


def delete(df: DataFrame, requests: DataFrame) -> DataFrame:
    return df.join(_ids(requests), "customer_id", "left_anti").select(*df.columns)


def has_rule(name: str) -> bool:
    return name in PII or name in DELETED or name in PAYLOADS


def covered(lake) -> list[str]:
    """Stored tables that an erasure has to change; a table that nobody has decided about stops it."""
    stored = lake.names()
    if unknown := [n for n in stored if not has_rule(n) and n not in KEPT]:
        raise ValueError(f"no erasure rule for {', '.join(unknown)}")  # fail closed
    return [n for n in stored if has_rule(n)]


def erase(tables: dict[str, DataFrame], registry: DataFrame, requests: DataFrame, now: float) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(tables after, registry after, audit rows); requests(request_id, customer_id, requested_at)."""
    after = {}
    for name, df in tables.items():
        if name in PII:
            after[name] = mask(df, requests, PII[name])
        elif name in PAYLOADS:
            after[name] = without_customers(df, requests)
        elif name in DELETED:
            after[name] = delete(df, requests)
        else:
            raise ValueError(f"no erasure rule for {name}")  # fail closed
    audit = audit_rows(tables, requests, now)
    return after, suppress(registry, requests.select("customer_id", F.lit(now).alias("added_at"))), audit


def append_audit(audit: DataFrame, new: DataFrame) -> DataFrame:
    """One attestation per request: a repeated one, the last by completion, replaces the former."""
    w = Window.partitionBy("request_id").orderBy(F.desc("completed_at"), F.desc("requested_at"), F.desc("customer_id"))
    latest = new.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
    return audit.join(latest.select("request_id"), "request_id", "left_anti").select(*audit.columns).unionByName(latest.select(*audit.columns))


def rows_in(lake, name: str, requests: DataFrame) -> DataFrame:
    """Stored rows, with the columns of the layout, that the erasure of the customers has to change."""
    if name in PAYLOADS:
        return rows_of(lake.stored(name), _ids(requests))
    rows = lake.of_customers(name, _ids(requests))
    return rows.where(in_clear(name)) if name in PII else rows


def in_clear(name: str) -> Column:
    """Whether a personal column of the table is not masked."""
    return reduce(lambda a, b: a | b, [~F.col(p).eqNullSafe(F.lit(MASK)) for p in PII[name]])


def touched(lake, name: str, requests: DataFrame) -> list[tuple[str, int]]:
    """Partitions of the table that hold such rows."""
    return [tuple(r) for r in rows_in(lake, name, requests).select("_batch", "_bucket").distinct().collect()]  # bounded by the partitions


#: Times that an erasure looks again for rows that another writer has brought meanwhile.
PASSES = 5


def run_erasure(lake, requests: DataFrame, now: float) -> DataFrame:
    """Erase over all stored tables: suppression first, then the partitions that hold the customers, then the attestation.

    A batch that another writer adds meanwhile has partitions of its own and is kept; as it may hold the customers, the
    tables are searched again until nothing is found.
    """
    covered(lake)
    who = _ids(requests)
    old = lake.read("governance.suppression_registry") if lake.exists("governance.suppression_registry") else requests.sparkSession.createDataFrame([], "customer_id string, added_at double")
    lake.append("governance.suppression_registry", who.join(old.select("customer_id").distinct(), "customer_id", "left_anti").select("customer_id", F.lit(now).alias("added_at")))
    for _ in range(PASSES):
        found = {n: parts for n in covered(lake) if (parts := touched(lake, n, requests))}
        if not found:
            break
        for name, parts in found.items():
            if name in PII:
                lake.rewrite(name, parts, lambda rows, name=name: mask(rows, requests, PII[name]))
            elif name in PAYLOADS:
                lake.rewrite(name, parts, lambda rows: without_customers(rows, who))
            else:
                lake.rewrite(name, parts, lambda rows: delete(rows, requests))
    else:
        raise RuntimeError(f"rows of the customers keep coming: {', '.join(found)}")
    audit = audit_rows(covered(lake), requests, now)
    log = lake.read("governance.erasure_audit_log") if lake.exists("governance.erasure_audit_log") else audit.limit(0)
    lake.write("governance.erasure_audit_log", append_audit(log, audit))
    return lake.read("governance.erasure_audit_log")


def audit_rows(names: Iterable[str], requests: DataFrame, now: float) -> DataFrame:
    return requests.select(
        "request_id", "customer_id", "requested_at", F.lit(now).alias("completed_at"), F.lit(",".join(sorted(names))).alias("layers_touched"),
        F.lit("completed").alias("status"), confirmation_hash("request_id", "customer_id").alias("confirmation_hash"),
    )


def verify_erasure(requests: DataFrame, registry: DataFrame, tables: dict[str, DataFrame], audit: DataFrame) -> DataFrame:
    """Per customer: suppressed, no rows left (quarantines, alerts and payloads that name the customer included), Bronze masked,
    an audit row, and all of these."""
    out = _ids(requests).join(registry.select("customer_id").distinct().withColumn("suppressed", F.lit(True)), "customer_id", "left")
    counts = []
    for name, df in tables.items():
        c = name.replace(".", "_")
        if name in PAYLOADS:
            found = rows_of(df, _ids(requests)).groupBy(F.col("named").alias("customer_id"))
        else:
            found = (df.where(in_clear(name)) if name in PII else df).join(_ids(requests), "customer_id", "left_semi").groupBy("customer_id")
        out = out.join(found.agg(F.count("*").alias(c)), "customer_id", "left")
        counts.append(c)
    out = out.join(audit.groupBy("customer_id").agg(F.count("*").alias("audits")), "customer_id", "left")
    zero = reduce(lambda a, b: a & b, [F.coalesce(F.col(c), F.lit(0)) == 0 for c in counts])
    passed = F.coalesce("suppressed", F.lit(False)) & zero & (F.coalesce("audits", F.lit(0)) >= 1)
    return out.select("customer_id", F.coalesce("suppressed", F.lit(False)).alias("suppressed"), *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts], F.coalesce("audits", F.lit(0)).alias("audits"), passed.alias("passed"))


def verify_refresh(requests: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count, passed: no row of the customers is left."""
    parts = [df.join(_ids(requests), "customer_id", "left_semi").agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count", (F.col("row_count") == 0).alias("passed")) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def physical_scan(lake, name: str, requests: DataFrame) -> DataFrame:
    """file, row_count of every data file in the table's folder that still holds a customer, whether the catalogue knows it or
    not; personal columns of Bronze count if they are not masked, payloads if they name the customer."""
    held = lake.spark.read.schema(lake.read(name).schema).option("recursiveFileLookup", "true").parquet(lake.location(name)).withColumn("file", F.input_file_name())
    if name in PAYLOADS:
        left = rows_of(held, _ids(requests))
    else:
        left = (held.where(in_clear(name)) if name in PII else held).join(_ids(requests), "customer_id", "left_semi")
    return left.groupBy("file").agg(F.count("*").alias("row_count"))


def replay_identity(incoming: DataFrame, state: DataFrame) -> DataFrame:
    """Each incoming command as new, replay or conflict, by its idempotency key; in-batch conflicts count."""
    w = Window.partitionBy("idempotency_key")
    many = (F.size(F.collect_set("customer_id").over(w)) > 1) | (F.size(F.collect_set("ticket_id").over(w)) > 1)
    known = state.select("idempotency_key", F.col("customer_id").alias("c0"), F.col("ticket_id").alias("t0"), F.col("status").alias("known_status"))
    both = incoming.withColumn("many", many).join(known, "idempotency_key", "left")
    other = ~F.col("customer_id").eqNullSafe(F.col("c0")) | ~F.col("ticket_id").eqNullSafe(F.col("t0"))
    outcome = F.when(F.col("many"), "conflict").when(F.col("known_status").isNull(), "new").when(other, "conflict").otherwise("replay")
    return both.select(*incoming.columns, outcome.alias("outcome"), F.when(outcome == "replay", F.col("known_status")).alias("known_status"))


def find_commands(state: DataFrame, wanted: DataFrame) -> DataFrame:
    """Commands by command_id or by idempotency key: two equi-joins, one row per command."""
    by_id = state.join(wanted.select("command_id").where("command_id is not null").distinct(), "command_id", "left_semi")
    by_key = state.join(wanted.select("idempotency_key").where("idempotency_key is not null").distinct(), "idempotency_key", "left_semi").select(*by_id.columns)
    return by_id.unionByName(by_key).dropDuplicates(["command_id"])


def advance(state: DataFrame, events: DataFrame, now: float, slo_s: float = 60.0) -> DataFrame:
    """Commands after events(command_id, event, layer, message): start, complete, fail.

    Completion needs the three verifications and a refresh id; a refused one blocks its layer and stays running.
    """
    e = events.groupBy("command_id").agg(F.max_by("event", "at").alias("event"), F.max_by("layer", "at").alias("layer"), F.max_by("message", "at").alias("message"))
    both = state.join(e, "command_id", "left")
    proven = F.col("logical_verified") & F.col("physical_verified") & F.col("export_verified") & F.col("refresh_id").isNotNull()
    done = (F.col("event") == "complete") & F.coalesce(proven, F.lit(False))
    refused = (F.col("event") == "complete") & ~F.coalesce(proven, F.lit(False))
    status = F.when(F.col("status").isin("completed"), F.col("status")).when(F.col("event") == "start", "running").when(done, "completed").when(F.col("event") == "fail", "failed").otherwise(F.col("status"))
    slo = F.when(F.col("completed_at").isNull() & ~done, F.when(now - F.col("requested_at") > slo_s, "breached").otherwise("open"))
    return both.select(
        *[c for c in state.columns if c not in ("status", "attempts", "completed_at", "blocked_layer", "failure_message", "slo_state")],
        status.alias("status"), (F.col("attempts") + F.when(F.col("event") == "start", 1).otherwise(0)).alias("attempts"),
        F.when(done & F.col("completed_at").isNull(), F.lit(now)).otherwise(F.col("completed_at")).alias("completed_at"),
        F.when(refused, F.coalesce("layer", F.lit("verification"))).when(F.col("event") == "fail", F.col("layer")).otherwise(F.when(done, None).otherwise(F.col("blocked_layer"))).alias("blocked_layer"),
        F.when(F.col("event") == "fail", F.col("message")).otherwise(F.col("failure_message")).alias("failure_message"),
        F.coalesce(slo, F.when(F.when(done, F.lit(now)).otherwise(F.col("completed_at")) - F.col("requested_at") > slo_s, "breached").otherwise("met")).alias("slo_state"),
    ).select(*state.columns)


def state_violations(state: DataFrame) -> DataFrame:
    """command_id and rule of every constraint that a stored command breaks."""
    rules = {
        "status": "status IN ('queued', 'running', 'completed', 'failed')",
        "attempts": "attempts >= 0",
        "proof": "status <> 'completed' OR (logical_verified AND physical_verified AND export_verified AND refresh_id IS NOT NULL)",
        "times": "completed_at IS NULL OR completed_at >= requested_at",
        "failure": "status <> 'failed' OR failure_message IS NOT NULL",
    }
    broken = F.filter(F.array(*[F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(name)) for name, sql in rules.items()]), lambda r: r.isNotNull())
    return state.select("command_id", F.explode(broken).alias("rule"))


def request_lifecycle(intake: DataFrame, audit: DataFrame) -> DataFrame:
    """Every request once: pending from the intake, or with the status of its audit row."""
    w = Window.partitionBy("request_id").orderBy(F.desc("requested_at"))
    newest = intake.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    a = audit.select("request_id", F.col("customer_id").alias("c"), F.col("status").alias("s"), "completed_at", F.col("requested_at").alias("t"))
    both = newest.join(a, "request_id", "full_outer")
    return both.select("request_id", F.coalesce("customer_id", "c").alias("customer_id"), F.coalesce("s", F.lit("pending")).alias("status"), F.coalesce("requested_at", "t").alias("requested_at"), "completed_at", "requested_by", "reason")


def filter_requests(lifecycle: DataFrame, status: str | None = None, customer: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of requests, newest first."""
    if status is not None:
        lifecycle = lifecycle.where(F.col("status") == status)
    if customer is not None:
        lifecycle = lifecycle.where(F.col("customer_id") == customer)
    return lifecycle.orderBy(F.desc("requested_at"), "request_id").offset(offset).limit(limit)
