"""Dashboard reports, service levels and latency statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glasslake.operators.ordered import ranks


def consent_by_country(gold_customers: DataFrame) -> DataFrame:
    yes, no = F.count_if("consents_marketing"), F.count_if(~F.col("consents_marketing"))
    rate = F.round(100.0 * yes / F.nullif(F.count("*"), F.lit(0)), 1)
    return gold_customers.groupBy("country").agg(F.count("*").alias("customer_count"), yes.alias("opted_in_count"), no.alias("opted_out_count"), rate.alias("consent_rate_pct"))


def customers_report(gold_customers: DataFrame, fraud: DataFrame, registry: DataFrame, search: str = "", country: str = "", consent: str = "ALL", limit: int | None = None, offset: int = 0) -> DataFrame:
    """Customer profiles: filters are values of parameters, never pasted into SQL text."""
    if consent not in ("ALL", "OPTED_IN", "OPTED_OUT"):
        raise ValueError(f"unknown consent filter {consent!r}")
    found = gold_customers
    if search:
        found = found.where(F.contains(F.lower("customer_id"), F.lit(search.lower())))
    if country:
        found = found.where(F.col("country") == country)
    if consent != "ALL":
        found = found.where(F.col("consents_marketing") == (consent == "OPTED_IN"))
    counts = [F.coalesce(c, F.lit(0)) for c in ("velocity_alerts", "zscore_alerts", "geo_alerts")]
    marked = registry.select("customer_id").distinct().withColumn("suppressed", F.lit(True))
    out = (
        found.join(fraud, "customer_id", "left")
        .join(marked, "customer_id", "left")
        .select(
            "customer_id", "country", "order_count", "lifetime_spend_eur", (F.col("lifetime_spend_eur") / F.nullif("order_count", F.lit(0))).alias("average_order_value_eur"),
            F.col("consents_marketing").alias("marketing_consent"), *[c.alias(n) for c, n in zip(counts, ("velocity_alerts", "zscore_alerts", "geo_alerts"), strict=True)],
            reduce(lambda a, b: a + b, counts).alias("fraud_alert_count"), "last_alert_at", F.coalesce("suppressed", F.lit(False)).alias("suppressed"), "last_order_at",
        )
    )
    return out.orderBy("customer_id").offset(offset).limit(limit) if limit is not None else out


def overview_kpis(gold_customers: DataFrame, fraud: DataFrame, quality: DataFrame, commands: DataFrame, registry: DataFrame, now: float) -> DataFrame:
    """One row of totals; quality of the last 24 hours, erasures of the last 30 days."""
    c = gold_customers.agg(F.count("*").alias("customer_count"), F.count_if("consents_marketing").alias("consented_customers"), F.round(F.coalesce(F.sum("lifetime_spend_eur"), F.lit(0.0)), 2).alias("lifetime_spend_eur"), F.max("last_order_at").alias("latest_order_at"))
    f = fraud.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("velocity_alerts", "zscore_alerts", "geo_alerts")], F.max("last_alert_at").alias("latest_alert_at"))
    q = quality.where(F.col("checked_at") >= now - 86_400).agg(F.round(F.avg(F.col("passed").cast("double")), 4).alias("quality_pass_rate"), F.max("checked_at").alias("last_quality_check_at"))
    e = commands.where(F.col("requested_at") >= now - 30 * 86_400).agg(
        F.count("*").alias("erasure_requests"), F.count_if(F.lower("status") == "completed").alias("completed_erasures"), F.count_if(F.lower("status") == "failed").alias("failed_erasures"),
        F.round(F.avg("latency_seconds"), 3).alias("average_latency_seconds"),
    )
    s = registry.agg(F.count_distinct("customer_id").alias("suppressed_customers"))
    one = c.crossJoin(f).crossJoin(q).crossJoin(e).crossJoin(s)  # five one-row aggregates
    return one.withColumn("fraud_alert_count", F.col("velocity_alerts") + F.col("zscore_alerts") + F.col("geo_alerts"))


def top_fraud_customers(fraud: DataFrame, limit: int = 100) -> DataFrame:
    total = F.coalesce("velocity_alerts", F.lit(0)) + F.coalesce("zscore_alerts", F.lit(0)) + F.coalesce("geo_alerts", F.lit(0))
    return fraud.withColumn("total_alerts", total).where("total_alerts > 0").orderBy(F.desc("total_alerts"), F.desc("last_alert_at"), "customer_id").limit(limit)


def erasure_impact_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, customer_id, row_count over all tables."""
    parts = [df.groupBy("customer_id").agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def erasure_impact(counts: DataFrame, registry: DataFrame, tables: list[str]) -> DataFrame:
    """Rows per table, one column each, and whether the customer is suppressed already."""
    columns = [F.coalesce(F.max(F.when(F.col("table_name") == t, F.col("row_count"))), F.lit(0)).alias(f"{t.replace('.', '_')}_rows") for t in tables]
    marked = registry.select("customer_id").distinct().withColumn("s", F.lit(True))
    return counts.where("customer_id is not null").groupBy("customer_id").agg(*columns).join(marked, "customer_id", "left").withColumn("already_suppressed", F.coalesce("s", F.lit(False))).drop("s")


def quality_latest(results: DataFrame) -> DataFrame:
    w = Window.partitionBy("check_name").orderBy(F.desc("checked_at"), F.desc("run_id"))
    return results.withColumn("r", F.row_number().over(w)).where("r = 1").select("check_name", "passed", "detail", "checked_at")


def erasure_audit(commands: DataFrame, limit: int = 25) -> DataFrame:
    state = F.when(F.col("physical_verified"), "FRAUD_SINK_PURGED").when(F.col("status").isin("failed", "running", "queued"), F.col("status")).otherwise("PENDING")
    return commands.withColumn("physical_purge_status", state).orderBy(F.desc("requested_at"), "request_id").limit(limit)


def erasure_sla(audit: DataFrame, limit_s: float = 60.0) -> DataFrame:
    """Latency, breaches and counts by status."""
    late = audit.withColumn("latency", F.col("completed_at") - F.col("requested_at"))
    return late.groupBy("status").agg(F.count("*").alias("requests"), F.round(F.avg("latency"), 3).alias("mean_latency_s"), F.round(F.max("latency"), 3).alias("max_latency_s"), F.count_if(F.col("latency") > limit_s).alias("breaches"))


def most_recent(df: DataFrame, order: str, tie: str, limit: int = 50) -> DataFrame:
    return df.orderBy(F.desc(order), tie).limit(limit)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])


def slo_windows(log: DataFrame, target: float = 0.99, size: int = 86_400, slide: int = 43_200) -> DataFrame:
    """Success ratio, burn rate and remaining error budget per sliding window; only 5xx answers spend budget."""
    w = F.window(F.timestamp_seconds("at_s"), f"{size} seconds", f"{slide} seconds")
    per = log.groupBy(w.alias("w")).agg(F.count("*").alias("requests"), F.count_if(F.col("status") >= 500).alias("errors"))
    burn = (F.col("errors") / F.col("requests")) / (1 - target)
    return per.select(F.unix_timestamp("w.start").alias("window_start"), "requests", "errors", F.round(1 - F.col("errors") / F.col("requests"), 6).alias("success_ratio"), F.round(burn, 4).alias("burn_rate"), F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - burn)), 4).alias("budget_left"))


def slo_state(log: DataFrame, ends_at: float, target: float = 0.99, size: int = 86_400) -> DataFrame:
    """One row: success ratio, burn rate and remaining error budget of the window that ends at a moment, or at the newest
    request if that is later. Only 5xx answers spend budget; without traffic it is full."""
    end = F.greatest(F.lit(float(ends_at)), F.coalesce(F.max("at_s"), F.lit(float(ends_at))))
    timed = log.crossJoin(F.broadcast(log.agg(end.alias("window_end"))))  # a one-row aggregate
    inside = F.col("at_s") >= F.col("window_end") - size
    per = timed.agg(F.count_if(inside).alias("requests"), F.count_if(inside & (F.col("status") >= 500)).alias("errors"), F.coalesce(F.max("window_end"), F.lit(float(ends_at))).alias("window_end"))
    rate = F.coalesce(F.col("errors") / F.nullif("requests", F.lit(0)), F.lit(0.0))
    burn = rate / (1 - target) if target < 1 else F.lit(0.0)
    left = F.when(F.col("requests") == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - burn)))
    return per.select("window_end", "requests", "errors", F.round(1 - rate, 6).alias("success_ratio"), F.round(burn, 4).alias("burn_rate"), F.round(left, 4).alias("budget_left"))


def order_statistics(log: DataFrame, group: str, value: str, wanted: dict[str, tuple[float, str]]) -> DataFrame:
    """group and one column for each name in wanted: (fraction, "cont" or "disc"), exact for groups of any size.

    Values are ranked by ranges (ordered.ranks), so a group is spread over tasks; the few rows at the ranks that are
    asked for make the result. A fraction between two ranks is interpolated ("cont") or takes the upper one ("disc").
    """
    ranked = ranks(log.where(F.col(value).isNotNull()).select(group, value), [group], [value], "order-statistics")
    n, targets = F.col("group_rows"), {}
    for name, (p, kind) in wanted.items():
        at = 1 + (n - 1) * p if kind == "cont" else F.greatest(F.lit(1), n - F.floor(n - n * p))
        targets[name] = (F.floor(at), F.ceil(at), at - F.floor(at))
    hit = F.lit(False)
    for low, high, _ in targets.values():
        hit = hit | (F.col("rank") == low) | (F.col("rank") == high)
    columns = []
    for name, (low, high, share) in targets.items():
        below, above = F.max(F.when(F.col("rank") == low, F.col(value))), F.max(F.when(F.col("rank") == high, F.col(value)))
        columns.append((below + (above - below) * F.max(share)).alias(name) if wanted[name][1] == "cont" else above.alias(name))
    return ranked.where(hit).groupBy(group).agg(*columns)


def latency_percentiles(log: DataFrame) -> DataFrame:
    sums = log.groupBy("endpoint").agg(F.round(F.avg("latency_ms"), 4).alias("mean"), F.min("latency_ms").alias("least"), F.max("latency_ms").alias("most"))
    at = order_statistics(log, "endpoint", "latency_ms", {"median": (0.5, "cont"), "p95": (0.95, "cont")})
    both = sums.alias("a").join(at.alias("b"), F.col("a.endpoint").eqNullSafe(F.col("b.endpoint")), "left")
    return both.select("a.endpoint", "mean", F.round("median", 4).alias("median"), F.round("p95", 4).alias("p95"), "least", "most")


def latency_nearest_rank(log: DataFrame) -> DataFrame:
    errors = F.count_if(F.col("status") >= 500)
    sums = log.groupBy("endpoint").agg(F.count("*").alias("requests"), errors.alias("server_errors"), F.max("latency_ms").alias("most"), (errors == 0).alias("passed"))
    at = order_statistics(log, "endpoint", "latency_ms", {f"p{k}": (k / 100, "disc") for k in (50, 95, 99)})
    both = sums.alias("a").join(at.alias("b"), F.col("a.endpoint").eqNullSafe(F.col("b.endpoint")), "left")
    return both.select("a.endpoint", "requests", "server_errors", "p50", "p95", "p99", "most", "passed")
