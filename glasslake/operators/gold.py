"""Gold: consent-aware aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.functions.scalars import hash_pii
from glasslake.operators.silver import CONSENT, flagged_orders, latest_order, newest_per
from glasslake.operators.suppression import not_suppressed


def customer_360(customers: DataFrame, orders: DataFrame, registry: DataFrame) -> DataFrame:
    """A row per customer with order totals. Consent fails closed: the customer's flag and that of all orders."""
    # shuffled once as narrow rows, by customer: distinct orders would be shuffled by order too, with the states of all aggregates
    mine = orders.select("customer_id", "order_id", "amount_eur", "occurred_at", "marketing_consent", "country", "email_hash", "event_id").repartition("customer_id")
    totals = mine.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("amount_eur").alias("spend"), F.min("occurred_at").alias("first_order_at"),
        F.max("occurred_at").alias("last_order_at"), F.expr(CONSENT).alias("gate"),
        F.min_by("country", F.struct("occurred_at", "event_id")).alias("order_country"), F.min_by("email_hash", F.struct("occurred_at", "event_id")).alias("order_email"),
    )
    consent = F.col("marketing_consent") & F.coalesce("gate", F.lit(True))
    return (
        not_suppressed(customers, registry)
        .join(totals, "customer_id", "left")
        .select(
            "customer_id", F.coalesce("country", "order_country").alias("country"), F.coalesce("email_hash", "order_email").alias("email_hash"),
            F.coalesce("order_count", F.lit(0)).alias("order_count"), F.round(F.coalesce("spend", F.lit(0.0)), 2).alias("lifetime_spend_eur"),
            "first_order_at", "last_order_at", consent.alias("consents_marketing"), consent.alias("marketing_consent"),
        )
    )


def customer_360_from_orders(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """customer_360 straight from order events: the orders are read, deduplicated and flagged once, then one aggregate
    gives the customer's latest row and the totals that customer_360 joins."""
    return customer_360_of(flagged_orders(orders, registry))


def customer_360_of(flagged: DataFrame) -> DataFrame:
    mine = flagged.where("customer_id is not null")
    ok = lambda c: F.when(F.col("ok"), F.col(c))
    found = mine.groupBy("customer_id").agg(
        latest_order().alias("r"), F.expr(CONSENT).alias("consent"), F.bool_or("ok").alias("any_ok"), F.count_distinct(ok("order_id")).alias("order_count"),
        F.sum(ok("amount_eur")).alias("spend"), F.min(ok("occurred_at")).alias("first_order_at"), F.max(ok("occurred_at")).alias("last_order_at"),
    )
    return found.where("any_ok").select(
        "customer_id", F.col("r.country").alias("country"), hash_pii("r.email").alias("email_hash"), "order_count", F.round("spend", 2).alias("lifetime_spend_eur"),
        "first_order_at", "last_order_at", F.col("consent").alias("consents_marketing"), F.col("consent").alias("marketing_consent"),
    )


def customer_360_local(customers: DataFrame, orders: DataFrame, alerts: DataFrame, registry: DataFrame) -> DataFrame:
    """Order totals, fraud flag and mirrored consent per customer; facts are aggregated before the joins.

    orders holds one row per order, as dedup_first gives them.
    """
    totals = orders.groupBy("customer_id").agg(F.count("order_id").alias("n"), F.sum("amount_eur").alias("total"))
    flags = alerts.groupBy("customer_id").agg((F.count("*") > 0).alias("fraud_flag"))
    return (
        not_suppressed(customers, registry)
        .join(totals, "customer_id", "left")
        .join(flags, "customer_id", "left")
        .select(
            "customer_id", F.coalesce("n", F.lit(0)).alias("total_orders"), F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total_spend_eur"),
            F.coalesce(F.round("total", 2) / F.col("n"), F.lit(0.0)).alias("avg_order_value_eur"), "marketing_consent", F.coalesce("fraud_flag", F.lit(False)).alias("fraud_flag"),
            "last_seen", F.col("marketing_consent").alias("consents_marketing"),
        )
    )


def order_facts(orders: DataFrame, gold_customers: DataFrame, registry: DataFrame) -> DataFrame:
    """Newest row per order of customers in customer_360, with the consent flag."""
    newest = newest_per(not_suppressed(orders, registry), "order_id", [F.col("occurred_at").desc(), F.col("event_id").desc()])
    flags = gold_customers.select("customer_id", "consents_marketing")
    return newest.join(flags, "customer_id").select("order_id", "customer_id", "amount_eur", "country", "occurred_at", "consents_marketing")


def fraud_summary_by_rule(alerts: DataFrame, registry: DataFrame) -> DataFrame:
    return not_suppressed(alerts, registry).groupBy("customer_id", "rule").agg(F.count("*").alias("alert_count"), F.max("alerted_at").alias("last_alert"))


def fraud_summary(alerts: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct alerts of each rule per customer, highest score and last alert."""
    seen = not_suppressed(alerts, registry)
    # an alert once, with its highest score: then the rules are counted without expanding the rows
    once = seen.groupBy("customer_id", "rule", "alert_id").agg(F.max("score").alias("score"), F.max("alerted_at").alias("alerted_at"))
    number = lambda rule: F.count_if((F.col("rule") == rule) & F.col("alert_id").isNotNull())
    return once.groupBy("customer_id").agg(
        number("VELOCITY").alias("velocity_alerts"), number("AMOUNT_ZSCORE").alias("zscore_alerts"), number("GEO_MISMATCH").alias("geo_alerts"),
        F.round(F.max("score"), 3).alias("max_score"), F.max("alerted_at").alias("last_alert_at"),
    )
