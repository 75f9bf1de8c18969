"""Silver: deduplicated, pseudonymised tables and their quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasslake.functions.scalars import hash_pii, is_valid_iban, live_pii
from glasslake.operators.ordered import written
from glasslake.operators.suppression import not_suppressed

STATUSES = ("authorized", "declined", "captured")
#: Hashes of repeated event ids up to which they are broadcast (some 50 bytes each); beyond that all rows are shuffled.
REPEATED_IDS = 3_000_000


def all_orders(*sources: DataFrame) -> DataFrame:
    """Orders of all sources (stream, partner files), missing columns as NULL."""
    first, *rest = sources
    for s in rest:
        first = first.unionByName(s, allowMissingColumns=True)
    return first


def newest_per(df: DataFrame, key: str, order: list[Column], within: str | None = None) -> DataFrame:
    w = Window.partitionBy(*([within] if within else []), key).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def _content(df: DataFrame) -> Column:
    """A hash of the whole row: the last tie-break of an ordering (maps have no order and do not count)."""
    return F.xxhash64(*[F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def dedup_events(df: DataFrame, within: str | None = None) -> DataFrame:
    """Newest row per event_id: by event time, ingest time and offset where the table has them, then by content.

    Rows without an event_id are no events of each other: all of them stay, and none enters the window. `within` names a
    column that the event_id fixes: rows that already lie together by it are not shuffled again.
    """
    order = [F.col(c).desc_nulls_last() for c in ("occurred_at", "_ingested_at", "_kafka_offset") if c in df.columns]
    newest = newest_per(df.where("event_id is not null"), "event_id", [*order, _content(df)], within)
    return newest.unionByName(df.where("event_id is null"))


def dedup_stored(df: DataFrame) -> DataFrame:
    """dedup_events of a stored table, whose rows stay where they lie but for those of repeated event ids.

    Hashes of the ids are counted first, so that the shuffle is of numbers and not of rows. The table is read three times.
    """
    h = F.when(F.col("event_id").isNotNull(), F.xxhash64("event_id"))
    counted = df.select(h.alias("__h")).where("__h is not null").groupBy("__h").agg(F.count("*").alias("__n")).where("__n > 1").select("__h")
    again = written(counted, "repeated-ids")
    if again.count() > REPEATED_IDS:
        return dedup_events(df)
    keyed, again = df.withColumn("__h", h), F.broadcast(again)
    alone = keyed.join(again, "__h", "left_anti").select(*df.columns)  # rows without an event_id among them
    return alone.unionByName(dedup_events(keyed.join(again, "__h", "left_semi").select(*df.columns)))


def dedup_first(df: DataFrame, key: str, count: bool = True) -> DataFrame:
    """First row per key by event time, then event_id; dedup_count tells how many rows there were, or 1."""
    w = Window.partitionBy(key)
    ranked = df.withColumn("__rank", F.row_number().over(w.orderBy("occurred_at", "event_id", _content(df))))
    ranked = ranked.withColumn("dedup_count", F.count("*").over(w) if count else F.lit(1).cast("long"))
    return ranked.where("__rank = 1").drop("__rank")


def _present(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def _of_type(df: DataFrame, event_type: str) -> Column:
    """Tables that keep the event type admit their own only."""
    return F.col("event_type").eqNullSafe(F.lit(event_type)) if "event_type" in df.columns else F.lit(True)


def order_flag(df: DataFrame) -> Column:
    """Whether an order enters Silver; one flag for both branches, never NULL."""
    ok = is_valid_iban("iban") & live_pii("email") & live_pii("iban") & _present("event_id", "order_id", "customer_id", "country", "marketing_consent", "occurred_at") & (F.col("amount_eur") >= 0) & _of_type(df, "order_placed")
    return F.coalesce(ok, F.lit(False))


def payment_flag(df: DataFrame) -> Column:
    """The same for a payment; a status may be missing but not unknown."""
    status = F.col("status").isNull() | F.col("status").isin(*STATUSES)
    ok = is_valid_iban("iban") & live_pii("iban") & _present("event_id", "payment_id", "order_id", "customer_id", "country", "merchant_country", "occurred_at") & (F.col("amount_eur") >= 0) & status & _of_type(df, "payment_processed")
    return F.coalesce(ok, F.lit(False))


def flagged_orders(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """Deduplicated orders of customers who are not suppressed, with `ok`: what all of Silver is made from."""
    kept = dedup_events(not_suppressed(orders, registry))
    return kept.withColumn("ok", order_flag(kept))


def flagged_payments(payments: DataFrame, registry: DataFrame, within: str | None = None) -> DataFrame:
    kept = dedup_events(not_suppressed(payments, registry), within)
    return kept.withColumn("ok", payment_flag(kept))


def flagged_stored(df: DataFrame, registry: DataFrame, flag: Callable[[DataFrame], Column]) -> DataFrame:
    """flagged_orders or flagged_payments of a stored table, without a shuffle of its rows."""
    kept = dedup_stored(not_suppressed(df, registry))
    return kept.withColumn("ok", flag(kept))


def _quarantine(flagged: DataFrame, pii: list[str], kind: str, identity: list[str]) -> DataFrame:
    """Rows that are not ok, with the reason; a row without an event_id is known by its other columns."""
    live = F.lit(True)
    for c in pii:
        live = live & live_pii(c)
    reason = F.when(~live, "PII_ANONYMIZED_OR_MISSING").when(~is_valid_iban("iban"), "IBAN_MOD97_FAILED").otherwise(f"{kind}_CONTRACT_FAILED")
    key = F.when(F.col("event_id").isNotNull(), F.concat(F.lit("event|"), "event_id")).otherwise(F.concat_ws("|", *identity))
    return flagged.where("NOT ok").select(F.sha2(key, 256).alias("quarantine_id"), "event_id", "customer_id", reason.alias("quarantine_reason"), "occurred_at")


def orders_quarantine(orders: DataFrame, registry: DataFrame) -> DataFrame:
    return bad_orders_of(flagged_orders(orders, registry))


def bad_orders_of(flagged: DataFrame) -> DataFrame:
    return _quarantine(flagged, ["email", "iban"], "ORDER", ["order_id", "customer_id", "iban"])


def payments_quarantine(payments: DataFrame, registry: DataFrame, within: str | None = None) -> DataFrame:
    return bad_payments_of(flagged_payments(payments, registry, within))


def bad_payments_of(flagged: DataFrame) -> DataFrame:
    return _quarantine(flagged, ["iban"], "PAYMENT", ["payment_id", "order_id", "customer_id", "iban"])


def silver_orders(orders: DataFrame, registry: DataFrame) -> DataFrame:
    return orders_of(flagged_orders(orders, registry))


def orders_of(flagged: DataFrame) -> DataFrame:
    return flagged.where("ok").select("event_id", "order_id", "customer_id", hash_pii("email").alias("email_hash"), hash_pii("iban").alias("iban_hash"), "country", "amount_eur", "currency", "marketing_consent", "occurred_at")


def silver_payments(payments: DataFrame, registry: DataFrame, within: str | None = None) -> DataFrame:
    return payments_of(flagged_payments(payments, registry, within))


def payments_of(flagged: DataFrame) -> DataFrame:
    return flagged.where("ok").select("event_id", "payment_id", "order_id", "customer_id", hash_pii("iban").alias("iban_hash"), "country", "merchant_country", "amount_eur", "status", "occurred_at")


#: Consent of all attributable orders, quarantined ones included; one that does not say is one that denies.
CONSENT = "bool_and(coalesce(marketing_consent, false))"


def latest_order() -> Column:
    """Country, email and iban of a customer's newest order that is ok."""
    return F.max_by(F.struct("country", "email", "iban"), F.when(F.col("ok"), F.struct("occurred_at", "event_id")))


def silver_customers(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """Latest valid row of each customer; consent holds only if no attributable order, quarantined ones included, denies it.

    One shuffle by customer: the latest row is an aggregate of structs and not a window.
    """
    return customers_of(flagged_orders(orders, registry))


def customers_of(flagged: DataFrame) -> DataFrame:
    found = flagged.where("customer_id is not null").groupBy("customer_id").agg(latest_order().alias("r"), F.expr(CONSENT).alias("marketing_consent"), F.bool_or("ok").alias("any_ok"))
    return found.where("any_ok").select("customer_id", F.col("r.country").alias("country"), hash_pii("r.email").alias("email_hash"), hash_pii("r.iban").alias("iban_hash"), "marketing_consent")


def silver_customers_arg_max(orders: DataFrame, registry: DataFrame) -> DataFrame:
    """Values of the newest row that has them; smallest country, consent of all rows, first and last seen."""
    kept = not_suppressed(orders, registry)
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("occurred_at", "event_id")))
    return kept.groupBy("customer_id").agg(
        hash_pii(newest("email")).alias("email_hash"), hash_pii(newest("iban")).alias("iban_hash"), F.min("country").alias("country"),
        F.expr(CONSENT).alias("marketing_consent"), F.min("occurred_at").alias("first_seen"), F.max("occurred_at").alias("last_seen"),
    )
