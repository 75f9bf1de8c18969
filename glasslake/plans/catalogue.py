"""All registered queries of the lakehouse operators and their SQL counterparts.

QUERIES maps a name to a function (spark, sf_dir) -> DataFrame; ORACLE_SQL gives the same rows as SQL over the given
tables. Shared relations are common table expressions, put in front of a query as far as it names them.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasslake.functions import scalars
from glasslake.operators import audit, contracts, erasure, fraud, gold, incremental, privacy, quality, reports, silver
from glasslake.operators.ordered import work_folder, written
from glasslake.operators.suppression import not_suppressed, suppress
from glasslake.sources import adapters, lake, tables
from glasslake.sources.adapters import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: Dates are whole days here, so the velocity window is 90 days.
BUCKET = 90 * 86_400
NOW = 1_735_689_600.0
SALT = scalars.DEFAULT_SALT

CTE = dict(adapters.SQL)
CTE |= {
    "order_kept": "SELECT * FROM order_ev o WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.customer_id = o.customer_id)",
    "pay_kept": "SELECT * FROM pay_ev p WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.customer_id = p.customer_id)",
    "order_new": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY occurred_at DESC) AS rn FROM order_kept) WHERE rn = 1",
    "pay_new": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY occurred_at DESC) AS rn FROM pay_kept) WHERE rn = 1",
    "s_orders": f"""SELECT event_id, order_id, customer_id, sha256('{SALT}:' || email) AS email_hash, sha256('{SALT}:' || iban) AS iban_hash, country, amount_eur, currency, marketing_consent, occurred_at
        FROM order_new WHERE iban_ok AND amount_eur >= 0""",
    "s_customers": f"""SELECT customer_id, arg_max(country, (occurred_at, event_id)) FILTER (iban_ok AND amount_eur >= 0) AS country,
        sha256('{SALT}:' || arg_max(email, (occurred_at, event_id)) FILTER (iban_ok AND amount_eur >= 0)) AS email_hash,
        sha256('{SALT}:' || arg_max(iban, (occurred_at, event_id)) FILTER (iban_ok AND amount_eur >= 0)) AS iban_hash, bool_and(coalesce(marketing_consent, FALSE)) AS marketing_consent
        FROM order_new GROUP BY customer_id HAVING bool_or(iban_ok AND amount_eur >= 0)""",
    "c360": """SELECT c.customer_id, c.country, c.email_hash, coalesce(t.n, 0) AS order_count, round(coalesce(t.spend, 0.0), 2) AS lifetime_spend_eur, t.first_order_at, t.last_order_at,
        c.marketing_consent AND coalesce(t.gate, TRUE) AS consents_marketing, c.marketing_consent AND coalesce(t.gate, TRUE) AS marketing_consent
        FROM s_customers c LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n, sum(amount_eur) AS spend, min(occurred_at) AS first_order_at, max(occurred_at) AS last_order_at, bool_and(coalesce(marketing_consent, FALSE)) AS gate
            FROM s_orders GROUP BY customer_id) t ON t.customer_id = c.customer_id""",
    # orders with gaps: columns that are NULL in one order of 31 each, among them the key itself
    "order_gap": "SELECT * REPLACE (" + ", ".join(f"CASE WHEN CAST(order_id AS BIGINT) % 31 = {k} THEN NULL ELSE {c} END AS {c}" for k, c in enumerate(("event_id", "country", "marketing_consent", "occurred_at", "customer_id", "email", "amount_eur"))) + ") FROM order_ev",
    "gap_new": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY occurred_at DESC NULLS LAST) AS rn FROM order_gap g WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.customer_id = g.customer_id)) WHERE rn = 1 OR event_id IS NULL""",
    "gap_flag": """SELECT *, coalesce(iban_ok AND email IS NOT NULL AND event_id IS NOT NULL AND customer_id IS NOT NULL AND country IS NOT NULL AND marketing_consent IS NOT NULL AND occurred_at IS NOT NULL AND amount_eur >= 0, FALSE) AS ok FROM gap_new""",
    "event_pay": "SELECT 'cust_' || user_id AS customer_id, CAST(event_id AS VARCHAR) AS event_id, epoch(ts) AS occurred_at, value AS amount_eur, user_id % 5 AS country, event_id % 7 AS merchant_country FROM events WHERE 'cust_' || user_id NOT IN (SELECT customer_id FROM registry)",
    "velocity": f"""SELECT customer_id, 'VELOCITY' AS rule, CAST(rn AS DOUBLE) AS score, event_id, occurred_at AS alerted_at, b AS window_start, b + {BUCKET} AS window_end
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, b ORDER BY occurred_at, event_id) AS rn FROM (SELECT *, CAST(floor(occurred_at / {BUCKET}) * {BUCKET} AS BIGINT) AS b FROM pay_ev)) WHERE rn = 6""",
    "zscore": """SELECT customer_id, 'AMOUNT_ZSCORE' AS rule, abs(amount_eur - mean) / sd AS score, event_id, occurred_at AS alerted_at, CAST(NULL AS BIGINT) AS window_start, CAST(NULL AS BIGINT) AS window_end
        FROM (SELECT *, count(amount_eur) OVER w AS n, avg(amount_eur) OVER w AS mean, stddev_samp(amount_eur) OVER w AS sd FROM pay_ev
              WINDOW w AS (PARTITION BY customer_id ORDER BY occurred_at, event_id ROWS BETWEEN 200 PRECEDING AND 1 PRECEDING))
        WHERE n >= 3 AND sd > 0 AND abs(amount_eur - mean) / sd > 3""",
    "geo_event": "SELECT customer_id, 'GEO_MISMATCH' AS rule, 1.0::DOUBLE AS score, event_id, occurred_at AS alerted_at, CAST(NULL AS BIGINT) AS window_start, CAST(NULL AS BIGINT) AS window_end FROM pay_ev WHERE country <> merchant_country",
    "geo_window": f"""SELECT customer_id, 'GEO_MISMATCH' AS rule, 1.0::DOUBLE AS score, event_id, occurred_at AS alerted_at, b AS window_start, b + {BUCKET} AS window_end
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, b ORDER BY occurred_at, event_id) AS rn FROM (SELECT *, CAST(floor(occurred_at / {BUCKET}) * {BUCKET} AS BIGINT) AS b FROM pay_ev WHERE region <> merchant_region)) WHERE rn = 1""",
    "alert_raw": "SELECT * FROM velocity UNION ALL SELECT * FROM zscore UNION ALL SELECT * FROM geo_event",
    "alerts": "SELECT *, sha256(concat_ws('|', rule, customer_id, event_id, coalesce(CAST(window_start AS VARCHAR), ''), coalesce(CAST(window_end AS VARCHAR), ''))) AS alert_id FROM alert_raw",
    "alerts_kept": "SELECT * FROM alerts a WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.customer_id = a.customer_id)",
    "fsum": """SELECT customer_id, count(DISTINCT CASE WHEN rule = 'VELOCITY' THEN alert_id END) AS velocity_alerts, count(DISTINCT CASE WHEN rule = 'AMOUNT_ZSCORE' THEN alert_id END) AS zscore_alerts,
        count(DISTINCT CASE WHEN rule = 'GEO_MISMATCH' THEN alert_id END) AS geo_alerts, round(max(score), 3) AS max_score, max(alerted_at) AS last_alert_at FROM alerts_kept GROUP BY customer_id""",
    "requests": "SELECT 'req-' || c_custkey AS request_id, 'cust_' || c_custkey AS customer_id, 1735689000.0::DOUBLE + c_custkey % 7 AS requested_at FROM customer WHERE c_custkey % 100 = 7",
    "intake": "SELECT 'req-' || c_custkey AS request_id, 'cust_' || c_custkey AS customer_id, 1735689000.0::DOUBLE + c_custkey % 7 AS requested_at FROM customer",
    "audit_log": f"""SELECT request_id, customer_id, requested_at, {NOW}::DOUBLE AS completed_at, 'bronze.orders,gold.customer_360' AS layers_touched, 'completed' AS status,
        substr(sha256(request_id || ':' || customer_id), 1, 16) AS confirmation_hash FROM intake""",
    "runs": "SELECT o_orderkey AS run_no, 'run-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS run_id, 'check-' || (o_orderkey % 17) AS check_name, o_orderkey % 5 <> 0 AS passed, o_orderpriority AS detail, epoch(o_orderdate) AS checked_at FROM orders",
    "commands": f"""SELECT 'cmd-' || o_orderkey AS command_id, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'failed' ELSE 'running' END AS status, {NOW} - (o_orderkey % 60) * 86400 AS requested_at,
        CAST(o_orderkey % 90 AS DOUBLE) AS latency_seconds FROM orders""",
}


def with_ctes(body: str) -> str:
    """The statement behind the common table expressions that it names, directly or through others."""
    names = [n for n in CTE if re.search(rf"\b{n}\b", body)]
    need: set[str] = set()
    while names:
        n = names.pop()
        if n not in need:
            need.add(n)
            names += [m for m in CTE if m != n and re.search(rf"\b{m}\b", CTE[n])]
    parts = [f"{n} AS ({CTE[n]})" for n in CTE if n in need]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_ctes(sql)
        return f

    return put


def _base(spark, d):
    return adapters.orders_placed(spark, d), adapters.payments_processed(spark, d), adapters.suppression_registry(spark, d)


def _gaps(spark, d):
    """Orders with gaps, as the relation order_gap."""
    o = adapters.orders_placed(spark, d)
    k = F.col("order_id").cast("long") % 31
    return o.withColumns({c: F.when(k != n, F.col(c)) for n, c in enumerate(("event_id", "country", "marketing_consent", "occurred_at", "customer_id", "email", "amount_eur"))})


def _gold(spark, d):
    o, _, r = _base(spark, d)
    return gold.customer_360_from_orders(o, r)


def _alerts(spark, d):
    return fraud.all_alerts(adapters.payments_processed(spark, d), BUCKET, parts=adapters.payment_parts(spark, d))


def _fraud_summary(spark, d):
    return gold.fraud_summary(_alerts(spark, d), adapters.suppression_registry(spark, d))


def _requests(spark, d):
    """The customers who ask for erasure: one in a hundred."""
    return _intake(spark, d, "c_custkey % 100 = 7")


def _intake(spark, d, who="true"):
    c = table(spark, d, "customer").where(who)
    return c.select(F.concat(F.lit("req-"), "c_custkey").alias("request_id"), F.concat(F.lit("cust_"), "c_custkey").alias("customer_id"), (F.lit(1735689000.0) + F.col("c_custkey") % 7).alias("requested_at"))


def _audit(spark, d):
    """The audit log of a lake where every customer has asked."""
    return _intake(spark, d).select("request_id", "customer_id", "requested_at", F.lit(NOW).alias("completed_at"), F.lit("bronze.orders,gold.customer_360").alias("layers_touched"), F.lit("completed").alias("status"), scalars.confirmation_hash("request_id", "customer_id").alias("confirmation_hash"))


def _runs(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.concat(F.lit("run-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("run_id"), F.concat(F.lit("check-"), F.col("o_orderkey") % 17).alias("check_name"), (F.col("o_orderkey") % 5 != 0).alias("passed"),
        F.col("o_orderpriority").alias("detail"), scalars.epoch_seconds("o_orderdate").alias("checked_at"),
    )


def _commands(spark, d):
    o = table(spark, d, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "failed").otherwise("running")
    return o.select(F.concat(F.lit("cmd-"), "o_orderkey").alias("command_id"), status.alias("status"), (NOW - (F.col("o_orderkey") % 60) * 86400).alias("requested_at"), (F.col("o_orderkey") % 90).cast("double").alias("latency_seconds"))


# ---------------------------------------------------------------- Silver and Gold


@query("SELECT customer_id, country, email_hash, iban_hash, marketing_consent FROM s_customers")
def silver_customers(spark, d):
    o, _, r = _base(spark, d)
    return silver.silver_customers(o, r)


@query(f"""SELECT customer_id, sha256('{SALT}:' || arg_max(email, (occurred_at, event_id))) AS email_hash, sha256('{SALT}:' || arg_max(iban, (occurred_at, event_id))) AS iban_hash, min(country) AS country,
    bool_and(coalesce(marketing_consent, FALSE)) AS marketing_consent, min(occurred_at) AS first_seen, max(occurred_at) AS last_seen FROM order_kept GROUP BY customer_id""")
def silver_customers_arg_max(spark, d):
    o, _, r = _base(spark, d)
    return silver.silver_customers_arg_max(o, r)


@query("SELECT * FROM s_orders")
def silver_orders(spark, d):
    o, _, r = _base(spark, d)
    return silver.silver_orders(o, r)


@query("""SELECT order_id, customer_id, amount_eur, country, occurred_at, dedup_count FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY occurred_at, event_id) AS rn, count(*) OVER (PARTITION BY order_id) AS dedup_count FROM order_kept) WHERE rn = 1""")
def silver_orders_dedup(spark, d):
    o, _, r = _base(spark, d)
    return silver.dedup_first(not_suppressed(o, r), "order_id").select("order_id", "customer_id", "amount_eur", "country", "occurred_at", "dedup_count")


@query("""SELECT payment_id, order_id, customer_id, round(amount_eur, 4) AS amount_eur, country, merchant_country, status, occurred_at, dedup_count FROM (SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY occurred_at, event_id) AS rn,
    count(*) OVER (PARTITION BY payment_id) AS dedup_count FROM pay_kept) WHERE rn = 1""")
def silver_payments(spark, d):
    _, p, r = _base(spark, d)
    first = silver.dedup_first(not_suppressed(p, r), "payment_id")
    return first.select("payment_id", "order_id", "customer_id", F.round("amount_eur", 4).alias("amount_eur"), "country", "merchant_country", "status", "occurred_at", "dedup_count")


@query(f"SELECT event_id, payment_id, order_id, customer_id, sha256('{SALT}:' || iban) AS iban_hash, country, merchant_country, round(amount_eur, 4) AS amount_eur, status, occurred_at FROM pay_new WHERE iban_ok AND amount_eur >= 0")
def silver_payments_pseudonymised(spark, d):
    _, p, r = _base(spark, d)
    return silver.silver_payments(p, r, adapters.PAYMENT_WITHIN).withColumn("amount_eur", F.round("amount_eur", 4))


@query("SELECT sha256('event|' || event_id) AS quarantine_id, event_id, customer_id, 'IBAN_MOD97_FAILED' AS quarantine_reason, occurred_at FROM order_new WHERE NOT iban_ok")
def orders_quarantine(spark, d):
    o, _, r = _base(spark, d)
    return silver.orders_quarantine(o, r)


@query("SELECT sha256('event|' || event_id) AS quarantine_id, event_id, customer_id, 'IBAN_MOD97_FAILED' AS quarantine_reason, occurred_at FROM pay_new WHERE NOT iban_ok")
def payments_quarantine(spark, d):
    _, p, r = _base(spark, d)
    return silver.payments_quarantine(p, r, adapters.PAYMENT_WITHIN)


@query("SELECT event_id, order_id, customer_id, country, amount_eur, marketing_consent, occurred_at FROM gap_flag WHERE ok")
def silver_orders_gaps(spark, d):
    """Admission with NULL keys, countries, consents, times and amounts."""
    kept = silver.silver_orders(_gaps(spark, d), adapters.suppression_registry(spark, d))
    return kept.select("event_id", "order_id", "customer_id", "country", "amount_eur", "marketing_consent", "occurred_at")


@query("""SELECT sha256(CASE WHEN event_id IS NOT NULL THEN 'event|' || event_id ELSE concat_ws('|', order_id, customer_id, iban) END) AS quarantine_id, event_id, customer_id,
    CASE WHEN email IS NULL THEN 'PII_ANONYMIZED_OR_MISSING' WHEN NOT iban_ok THEN 'IBAN_MOD97_FAILED' ELSE 'ORDER_CONTRACT_FAILED' END AS quarantine_reason, occurred_at FROM gap_flag WHERE NOT ok""")
def orders_quarantine_gaps(spark, d):
    return silver.orders_quarantine(_gaps(spark, d), adapters.suppression_registry(spark, d))


@query("""SELECT customer_id, arg_max(country, (occurred_at, event_id)) FILTER (ok) AS country, bool_and(coalesce(marketing_consent, FALSE)) AS marketing_consent FROM gap_flag WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING bool_or(ok)""")
def silver_customers_gaps(spark, d):
    """An order that does not say whether its customer consents denies it."""
    return silver.silver_customers(_gaps(spark, d), adapters.suppression_registry(spark, d)).select("customer_id", "country", "marketing_consent")


@query("""SELECT count(*) AS rows_in, count(*) FILTER (ok) AS valid, count(*) FILTER (NOT ok) AS quarantined FROM gap_flag""")
def silver_partition_gaps(spark, d):
    """Every order, with or without an event_id, is valid or in quarantine."""
    o, r = _gaps(spark, d), adapters.suppression_registry(spark, d)
    sides = [silver.silver_orders(o, r).select(F.lit(1).alias("v")), silver.orders_quarantine(o, r).select(F.lit(0).alias("v"))]
    split = sides[0].unionByName(sides[1]).agg(F.count_if(F.col("v") == 1).alias("valid"), F.count_if(F.col("v") == 0).alias("quarantined"))
    kept = silver.dedup_events(not_suppressed(o, r)).agg(F.count("*").alias("rows_in"))
    return kept.crossJoin(split)  # one-row aggregates


@query("SELECT * FROM c360")
def customer_360(spark, d):
    return _gold(spark, d)


@query("SELECT * FROM c360")
def customer_360_stored(spark, d):
    """The same from Silver tables, as the batch pipeline builds it."""
    o, _, r = _base(spark, d)
    return gold.customer_360(silver.silver_customers(o, r), silver.silver_orders(o, r), r)


@query(f"""SELECT c.customer_id, coalesce(t.n, 0) AS total_orders, round(coalesce(t.total, 0.0), 2) AS total_spend_eur, coalesce(round(t.total, 2) / t.n, 0.0) AS avg_order_value_eur, c.marketing_consent,
    coalesce(f.flag, FALSE) AS fraud_flag, c.last_seen, c.marketing_consent AS consents_marketing
    FROM (SELECT customer_id, bool_and(coalesce(marketing_consent, FALSE)) AS marketing_consent, max(occurred_at) AS last_seen FROM order_kept GROUP BY customer_id) c
    LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n, sum(amount_eur) AS total FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY occurred_at, event_id) AS rn FROM order_kept) WHERE rn = 1 GROUP BY customer_id) t USING (customer_id)
    LEFT JOIN (SELECT customer_id, count(*) > 0 AS flag FROM zscore GROUP BY customer_id) f USING (customer_id)""")
def customer_360_local(spark, d):
    o, p, r = _base(spark, d)
    return gold.customer_360_local(silver.silver_customers_arg_max(o, r), silver.dedup_first(not_suppressed(o, r), "order_id"), fraud.zscore(p, parts=adapters.payment_parts(spark, d)), r)


@query("""SELECT o.order_id, o.customer_id, o.amount_eur, o.country, o.occurred_at, c.consents_marketing FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY occurred_at DESC, event_id DESC) AS rk FROM s_orders) o JOIN c360 c USING (customer_id) WHERE rk = 1""")
def order_facts(spark, d):
    o, _, r = _base(spark, d)
    return gold.order_facts(silver.silver_orders(o, r), gold.customer_360_from_orders(o, r), r)


# ---------------------------------------------------------------- fraud


@query("SELECT customer_id, rule, score, event_id, alerted_at, window_start, window_end FROM velocity")
def fraud_velocity(spark, d):
    return fraud.velocity(adapters.payments_processed(spark, d), BUCKET).drop("alert_id")


@query("SELECT customer_id, rule, round(score, 3) AS score, event_id, alerted_at FROM zscore")
def fraud_zscore(spark, d):
    return fraud.zscore(adapters.payments_processed(spark, d)).select("customer_id", "rule", F.round("score", 3).alias("score"), "event_id", "alerted_at")


@query("SELECT customer_id, rule, event_id, alerted_at FROM geo_event")
def fraud_geo_event(spark, d):
    return fraud.geo_mismatch(adapters.payments_processed(spark, d)).select("customer_id", "rule", "event_id", "alerted_at")


@query("SELECT customer_id, rule, event_id, alerted_at, window_start, window_end FROM geo_window")
def fraud_geo_window(spark, d):
    found = fraud.geo_mismatch(adapters.payments_processed(spark, d), "window", BUCKET, "region", "merchant_region")
    return found.select("customer_id", "rule", "event_id", "alerted_at", "window_start", "window_end")


@query("SELECT alert_id, rule, event_id FROM alerts")
def fraud_alert_ids(spark, d):
    return _alerts(spark, d).select("alert_id", "rule", "event_id")


@query("SELECT customer_id, rule, count(*) AS alert_count, max(alerted_at) AS last_alert FROM alerts_kept GROUP BY customer_id, rule")
def fraud_summary_by_rule(spark, d):
    return gold.fraud_summary_by_rule(_alerts(spark, d), adapters.suppression_registry(spark, d))


@query("SELECT * FROM fsum")
def fraud_summary_pivot(spark, d):
    return _fraud_summary(spark, d)


# ---------------------------------------------------------------- reports


@query("""SELECT country, count(*) AS customer_count, count(*) FILTER (consents_marketing) AS opted_in_count, count(*) FILTER (NOT consents_marketing) AS opted_out_count,
    round(100.0 * count(*) FILTER (consents_marketing) / nullif(count(*), 0), 1) AS consent_rate_pct FROM c360 GROUP BY country""")
def consent_by_country(spark, d):
    return reports.consent_by_country(_gold(spark, d))


@query("""SELECT c.customer_id, c.country, c.order_count, c.lifetime_spend_eur, c.lifetime_spend_eur / nullif(c.order_count, 0) AS average_order_value_eur, c.consents_marketing AS marketing_consent,
    coalesce(f.velocity_alerts, 0) AS velocity_alerts, coalesce(f.zscore_alerts, 0) AS zscore_alerts, coalesce(f.geo_alerts, 0) AS geo_alerts,
    coalesce(f.velocity_alerts, 0) + coalesce(f.zscore_alerts, 0) + coalesce(f.geo_alerts, 0) AS fraud_alert_count, f.last_alert_at, FALSE AS suppressed, c.last_order_at
    FROM c360 c LEFT JOIN fsum f USING (customer_id) WHERE contains(lower(c.customer_id), 'cust_1')""")
def customers_report(spark, d):
    return reports.customers_report(_gold(spark, d), _fraud_summary(spark, d), adapters.suppression_registry(spark, d), search="CUST_1")


@query(f"""SELECT * FROM (SELECT count(*) AS customer_count, count(*) FILTER (consents_marketing) AS consented_customers, round(sum(lifetime_spend_eur), 2) AS lifetime_spend_eur, max(last_order_at) AS latest_order_at FROM c360),
    (SELECT sum(velocity_alerts)::BIGINT AS velocity_alerts, sum(zscore_alerts)::BIGINT AS zscore_alerts, sum(geo_alerts)::BIGINT AS geo_alerts, max(last_alert_at) AS latest_alert_at, sum(velocity_alerts + zscore_alerts + geo_alerts)::BIGINT AS fraud_alert_count FROM fsum),
    (SELECT round(avg(passed::INT), 4) AS quality_pass_rate, max(checked_at) AS last_quality_check_at FROM runs WHERE checked_at >= {NOW} - 86400 * 10000),
    (SELECT count(*) AS erasure_requests, count(*) FILTER (status = 'completed') AS completed_erasures, count(*) FILTER (status = 'failed') AS failed_erasures, round(avg(latency_seconds), 3) AS average_latency_seconds FROM commands WHERE requested_at >= {NOW} - 30 * 86400),
    (SELECT count(DISTINCT customer_id) AS suppressed_customers FROM registry)""")
def overview_kpis(spark, d):
    runs = _runs(spark, d).withColumn("checked_at", F.col("checked_at"))
    shifted = runs.withColumn("checked_at", F.col("checked_at") + 86400 * 9999)  # the test runs are old: their day is moved near now
    out = reports.overview_kpis(_gold(spark, d), _fraud_summary(spark, d), shifted, _commands(spark, d), adapters.suppression_registry(spark, d), NOW)
    return out.withColumn("last_quality_check_at", F.col("last_quality_check_at") - 86400 * 9999)


@query("SELECT *, velocity_alerts + zscore_alerts + geo_alerts AS total_alerts FROM fsum WHERE velocity_alerts + zscore_alerts + geo_alerts > 0 ORDER BY total_alerts DESC, last_alert_at DESC, customer_id LIMIT 100")
def top_fraud_customers(spark, d):
    return reports.top_fraud_customers(_fraud_summary(spark, d))


@query("""SELECT customer_id, coalesce(max(n) FILTER (t = 'o'), 0) AS silver_orders_rows, coalesce(max(n) FILTER (t = 'p'), 0) AS silver_payments_rows, coalesce(max(n) FILTER (t = 'c'), 0) AS gold_customer_360_rows, FALSE AS already_suppressed
    FROM (SELECT 'o' AS t, customer_id, count(*) AS n FROM s_orders GROUP BY customer_id UNION ALL SELECT 'p', customer_id, count(*) FROM pay_new WHERE iban_ok GROUP BY customer_id UNION ALL SELECT 'c', customer_id, 1 FROM c360) GROUP BY customer_id""")
def erasure_impact(spark, d):
    o, p, r = _base(spark, d)
    t = {"silver.orders": silver.silver_orders(o, r), "silver.payments": silver.silver_payments(p, r, adapters.PAYMENT_WITHIN), "gold.customer_360": _gold(spark, d)}
    return reports.erasure_impact(reports.erasure_impact_counts(t), r, list(t))


@query("SELECT check_name, passed, detail, checked_at FROM (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY checked_at DESC, run_id DESC) AS r FROM runs) WHERE r = 1")
def quality_latest(spark, d):
    return reports.quality_latest(_runs(spark, d))


@query("SELECT status, count(*) AS requests, round(avg(latency_seconds), 3) AS mean_latency_s, round(max(latency_seconds), 3) AS max_latency_s, count(*) FILTER (latency_seconds > 60) AS breaches FROM commands GROUP BY status")
def erasure_sla(spark, d):
    return reports.erasure_sla(_commands(spark, d).withColumn("completed_at", F.col("requested_at") + F.col("latency_seconds")))


@query("""SELECT CAST(w AS BIGINT) AS window_start, count(*) AS requests, count(*) FILTER (status >= 500) AS errors, round(1 - count(*) FILTER (status >= 500) / count(*), 6) AS success_ratio, round(count(*) FILTER (status >= 500) / count(*) / (1 - 0.99::DOUBLE), 4) AS burn_rate,
    round(greatest(0.0, least(1.0, 1 - count(*) FILTER (status >= 500) / count(*) / (1 - 0.99::DOUBLE))), 4) AS budget_left
    FROM (SELECT *, floor(at_s / 43200) * 43200 - k * 43200 AS w FROM request_log, (VALUES (0), (1)) v(k)) GROUP BY w""")
def slo_window(spark, d):
    return reports.slo_windows(adapters.request_log(spark, d))


@query("SELECT endpoint, round(avg(latency_ms), 4) AS mean, round(quantile_cont(latency_ms, 0.5), 4) AS median, round(quantile_cont(latency_ms, 0.95), 4) AS p95, min(latency_ms) AS least, max(latency_ms) AS most FROM request_log GROUP BY endpoint")
def latency_percentiles(spark, d):
    return reports.latency_percentiles(adapters.request_log(spark, d))


@query("SELECT endpoint, count(*) AS requests, count(*) FILTER (status >= 500) AS server_errors, quantile_disc(latency_ms, 0.5) AS p50, quantile_disc(latency_ms, 0.95) AS p95, quantile_disc(latency_ms, 0.99) AS p99, max(latency_ms) AS most, count(*) FILTER (status >= 500) = 0 AS passed FROM request_log GROUP BY endpoint")
def latency_nearest_rank(spark, d):
    return reports.latency_nearest_rank(adapters.request_log(spark, d))


@query("SELECT 'bronze.orders' AS table_name, count(*) AS row_count FROM order_ev UNION ALL SELECT 'bronze.payments', count(*) FROM pay_ev UNION ALL SELECT 'bronze.clicks', count(*) FROM click_ev UNION ALL SELECT 'silver.orders', count(*) FROM s_orders UNION ALL SELECT 'gold.customer_360', count(*) FROM c360")
def table_counts(spark, d):
    o, p, r = _base(spark, d)
    return reports.table_counts({"bronze.orders": o, "bronze.payments": p, "bronze.clicks": adapters.page_clicks(spark, d), "silver.orders": silver.silver_orders(o, r), "gold.customer_360": _gold(spark, d)})


@query("SELECT run_id, check_name, passed, detail, checked_at FROM runs ORDER BY checked_at DESC, run_id LIMIT 50")
def most_recent_runs(spark, d):
    return reports.most_recent(_runs(spark, d), "checked_at", "run_id", 50)


# ---------------------------------------------------------------- quality


@query("SELECT 'unique:bronze.orders.event_id' AS check_name, count(*) FILTER (n > 1) = 0 AS passed, count(*) FILTER (n > 1) || ' duplicate keys' AS detail FROM (SELECT count(*) AS n FROM order_ev GROUP BY event_id) UNION ALL SELECT 'unique:silver.orders.event_id', count(*) FILTER (n > 1) = 0 AND sum(n) > 0, count(*) FILTER (n > 1) || ' duplicate keys' FROM (SELECT count(*) AS n FROM s_orders GROUP BY event_id)")
def dq_uniqueness(spark, d):
    o, _, r = _base(spark, d)
    return quality.uniqueness(o, "event_id", "bronze.orders").unionByName(quality.uniqueness(silver.silver_orders(o, r), "event_id", "silver.orders", allow_empty=False))


@query("""SELECT 'pii_not_clear:silver.customers.email_hash' AS check_name, count(*) FILTER (coalesce(NOT regexp_full_match(email_hash, '[0-9a-f]{64}') OR contains(email_hash, '@'), FALSE)) = 0 AS passed, count(*) FILTER (coalesce(NOT regexp_full_match(email_hash, '[0-9a-f]{64}') OR contains(email_hash, '@'), FALSE)) || ' of ' || count(*) AS detail FROM s_customers
    UNION ALL SELECT 'pii_not_clear:silver.customers.iban_hash' AS check_name, count(*) FILTER (coalesce(NOT regexp_full_match(iban_hash, '[0-9a-f]{64}') OR contains(iban_hash, '@'), FALSE)) = 0 AS passed, count(*) FILTER (coalesce(NOT regexp_full_match(iban_hash, '[0-9a-f]{64}') OR contains(iban_hash, '@'), FALSE)) || ' of ' || count(*) AS detail FROM s_customers
    UNION ALL SELECT 'pii_not_clear:bronze.orders.email' AS check_name, count(*) FILTER (coalesce(NOT regexp_full_match(email, '[0-9a-f]{64}') OR contains(email, '@'), FALSE)) = 0 AS passed, count(*) FILTER (coalesce(NOT regexp_full_match(email, '[0-9a-f]{64}') OR contains(email, '@'), FALSE)) || ' of ' || count(*) AS detail FROM order_ev""")
def dq_pii_not_clear(spark, d):
    o, _, r = _base(spark, d)
    return quality.pii_not_clear(silver.silver_customers(o, r), ["email_hash", "iban_hash"], "silver.customers").unionByName(quality.pii_not_clear(o, ["email"], "bronze.orders"))


@query("""SELECT 'consent_mirror:gold.customer_360' AS check_name, count(*) FILTER (consents_marketing IS DISTINCT FROM marketing_consent) = 0 AS passed, count(*) FILTER (consents_marketing IS DISTINCT FROM marketing_consent) || ' rows differ' AS detail FROM c360
    UNION ALL SELECT 'consent_mirror:newest_order', count(*) FILTER (c.consents_marketing IS DISTINCT FROM o.newest) = 0, count(*) FILTER (c.consents_marketing IS DISTINCT FROM o.newest) || ' rows differ'
    FROM c360 c JOIN (SELECT customer_id, arg_max(marketing_consent, (occurred_at, event_id)) AS newest FROM s_orders GROUP BY customer_id) o USING (customer_id)""")
def dq_consent(spark, d):
    """The mirrored flag, and the flag against the newest order's word, which differs where an earlier order denies."""
    o, _, r = _base(spark, d)
    people = _gold(spark, d)
    newest = silver.silver_orders(o, r).groupBy("customer_id").agg(F.max_by("marketing_consent", F.struct("occurred_at", "event_id")).alias("marketing_consent"))
    return quality.consent_mirror(people, "gold.customer_360").unionByName(quality.consent_mirror(people.drop("marketing_consent").join(newest, "customer_id"), "newest_order"))


@query("SELECT 'referential:silver.orders.customer_id' AS check_name, count(*) = 0 AS passed, count(*) || ' orphans' AS detail FROM order_kept o WHERE NOT EXISTS (SELECT 1 FROM s_customers c WHERE c.customer_id = o.customer_id)")
def dq_referential(spark, d):
    o, _, r = _base(spark, d)
    return quality.referential(not_suppressed(o, r), silver.silver_customers(o, r), "customer_id", "silver.orders")


@query("SELECT 'suppression:bronze.orders' AS check_name, count(*) = 0 AS passed, count(*) || ' suppressed rows' AS detail FROM order_ev JOIN registry USING (customer_id) UNION ALL SELECT 'suppression:silver.orders', count(*) = 0, count(*) || ' suppressed rows' FROM s_orders JOIN registry USING (customer_id)")
def dq_suppression(spark, d):
    o, _, r = _base(spark, d)
    return quality.suppression_enforced({"bronze.orders": o, "silver.orders": silver.silver_orders(o, r)}, r)


@query(f"SELECT 'freshness:bronze.orders' AS check_name, {NOW} - max(occurred_at) <= 3600 AS passed, CAST(floor({NOW} - max(occurred_at)) AS BIGINT) || ' s old' AS detail FROM order_ev UNION ALL SELECT 'freshness:bronze.clicks', {NOW} - max(occurred_at) <= 3600, CAST(floor({NOW} - max(occurred_at)) AS BIGINT) || ' s old' FROM click_ev")
def dq_freshness(spark, d):
    return quality.freshness({"bronze.orders": (adapters.orders_placed(spark, d), "occurred_at"), "bronze.clicks": (adapters.page_clicks(spark, d), "occurred_at")}, NOW)


@query("""SELECT 'volume:' || t AS check_name, CASE WHEN b IS NULL OR b = 0 THEN TRUE WHEN n = 0 THEN FALSE ELSE (b - n) * 100.0 / b <= 50 END AS passed, coalesce(CAST(b AS VARCHAR), 'baseline') || ' -> ' || n AS detail
    FROM (SELECT country AS t, count(*) AS n, any_value(b) AS b FROM order_ev LEFT JOIN (SELECT merchant_country AS country, count(*) AS b FROM pay_ev GROUP BY 1) USING (country) GROUP BY country)""")
def dq_volume(spark, d):
    now = adapters.orders_placed(spark, d).groupBy(F.col("country").alias("table_name")).agg(F.count("*").alias("row_count"))
    before = adapters.payments_processed(spark, d).groupBy(F.col("merchant_country").alias("table_name")).agg(F.count("*").alias("row_count")).withColumn("checked_at", F.lit(1.0))
    return quality.volume(now, before)


@query("SELECT 'k_anonymity:silver.customers' AS check_name, min(n) >= 2 AS passed, 'least ' || min(n) || ' in ' || count(*) || ' groups' AS detail FROM (SELECT count(DISTINCT customer_id) AS n FROM s_customers GROUP BY country, marketing_consent)")
def dq_k_anonymity(spark, d):
    o, _, r = _base(spark, d)
    return quality.k_anonymity(silver.silver_customers(o, r), ["country", "marketing_consent"], "silver.customers", 2)


@query("SELECT 'expect:bronze.payments.positive' AS check_name, count(*) FILTER (NOT amount_eur > 1000) = 0 AS passed, count(*) FILTER (NOT amount_eur > 1000) || ' of ' || count(*) AS detail FROM pay_ev UNION ALL SELECT 'expect:bronze.payments.status', count(*) FILTER (status NOT IN ('authorized', 'captured')) = 0, count(*) FILTER (status NOT IN ('authorized', 'captured')) || ' of ' || count(*) FROM pay_ev")
def dq_expectations(spark, d):
    return quality.expect(adapters.payments_processed(spark, d), {"positive": "amount_eur > 1000", "status": "status IN ('authorized', 'captured')"}, "bronze.payments")


# ---------------------------------------------------------------- functions, privacy, contracts


@query("SELECT customer_id, iban, iban_ok AS valid FROM cust")
def iban_valid(spark, d):
    return adapters.customers(spark, d).select("customer_id", "iban", scalars.is_valid_iban("iban").alias("valid"))


@query(f"SELECT customer_id, sha256('{SALT}:' || email) AS email_hash FROM cust")
def hash_pii(spark, d):
    return adapters.customers(spark, d).select("customer_id", scalars.hash_pii("email").alias("email_hash"))


@query(r"""SELECT 'bronze.orders' AS table_name, c AS column_name, string_agg(DISTINCT tag, ',' ORDER BY tag) AS pii_tags FROM
    (SELECT c, CASE WHEN regexp_full_match(v, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 'EMAIL' WHEN c = 'iban' AND ok THEN 'IBAN' END AS tag
     FROM (SELECT 'email' AS c, email AS v, iban_ok AS ok FROM order_ev UNION ALL SELECT 'iban', iban, iban_ok FROM order_ev UNION ALL SELECT 'order_id', order_id, FALSE FROM order_ev UNION ALL SELECT 'country', country, FALSE FROM order_ev)) WHERE tag IS NOT NULL GROUP BY c""")
def classify_columns(spark, d):
    o = adapters.orders_placed(spark, d).select("email", "iban", "amount_eur", "order_id", "country")
    return privacy.classify_columns(o, "bronze.orders").withColumn("pii_tags", F.array_join("pii_tags", ","))


@query(r"""SELECT * FROM (SELECT doc_id, len(regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})')) AS emails, len(regexp_extract_all(text, '\b([0-9]{1,3}(?:\.[0-9]{1,3}){3})\b')) AS ips,
    len(regexp_extract_all(text, '(\+[0-9][0-9\s().-]{7,})')) AS phones, len(regexp_extract_all(text, '\b([A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})\b')) AS ibans FROM documents) WHERE emails + ips + phones + ibans > 0""")
def pii_free_text(spark, d):
    return privacy.free_text_pii(table(spark, d, "documents"))


def _json_orders(spark, d):
    """Order events as JSON text, some of them broken on purpose."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    body = F.to_json(
        F.struct(
            F.when(k % 13 != 1, F.concat(F.lit("ord-"), k)).alias("event_id"), F.when(k % 13 == 2, "page_click").otherwise("order_placed").alias("event_type"), F.when(k % 13 == 3, 0.0).otherwise(scalars.epoch_seconds("o_orderdate")).alias("occurred_at"),
            k.cast("string").alias("order_id"), F.concat(F.lit("cust_"), "o_custkey").alias("customer_id"), F.when(k % 13 != 4, "a@example.com").alias("email"), F.lit("DE00").alias("iban"), F.lit("DE").alias("country"),
            F.when(k % 13 == 5, -1.0).otherwise(F.col("o_totalprice")).alias("amount_eur"), (k % 7 != 0).alias("marketing_consent"),
        )
    )
    return o.select(k.alias("o_orderkey"), F.when(k % 13 == 6, F.concat(F.lit("{"), body)).otherwise(body).alias("value"))


@query("""SELECT o_orderkey, CASE o_orderkey % 13 WHEN 6 THEN 'JSON_PARSE_ERROR' WHEN 1 THEN 'EVENT_ID_MISSING' WHEN 2 THEN 'EVENT_TYPE_MISMATCH' WHEN 4 THEN 'REQUIRED_FIELD_MISSING' WHEN 5 THEN 'BUSINESS_RULE_FAILED' WHEN 3 THEN 'INVALID_OCCURRED_AT' END AS quarantine_reason,
    o_orderkey % 13 BETWEEN 1 AND 6 AS _is_malformed, 'cust_' || o_custkey AS customer_id FROM orders""")
def contract_status(spark, d):
    parsed = contracts.parse(_json_orders(spark, d), "order_placed")
    rows = contracts.contract_status(contracts.with_lineage(contracts.recover_ids(contracts.normalise(parsed)), "test"), "order_placed")
    return rows.select("o_orderkey", "quarantine_reason", "_is_malformed", "customer_id")


#: Contracts of the orders before and from this date on are compared.
TURN = "1995-06-01"


@query(f"""WITH rec AS (SELECT o_orderdate >= DATE '{TURN}' AS late, 'cust_' || o_custkey AS topic, o_orderkey AS id, unnest(['status_' || o_orderstatus, 'total', 'year']) AS field, unnest([o_orderpriority[1:1]::DOUBLE, round(o_totalprice), CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE year(o_orderdate) END]) AS v FROM orders),
    con AS (SELECT late, topic, field, CASE WHEN count(*) FILTER (v <> floor(v)) > 0 THEN 'double' ELSE 'int' END AS type, count(DISTINCT id) = any_value(size) AS required FROM rec JOIN (SELECT late, topic, count(DISTINCT id) AS size FROM rec GROUP BY ALL) USING (late, topic) GROUP BY late, topic, field),
    b AS (SELECT * FROM con WHERE NOT late), c AS (SELECT * FROM con WHERE late)
    SELECT topic, '' AS field, 'TOPIC_REMOVED' AS change FROM (SELECT DISTINCT topic FROM b) WHERE topic NOT IN (SELECT topic FROM c)
    UNION ALL SELECT * FROM (SELECT topic, field, CASE WHEN c.type IS NULL AND b.required THEN 'REQUIRED_FIELD_REMOVED' WHEN b.type IS NULL AND c.required THEN 'REQUIRED_FIELD_ADDED' WHEN b.type <> c.type AND (b.required OR c.required) THEN 'TYPE_CHANGED'
        WHEN b.required AND NOT c.required THEN 'REQUIRED_MADE_OPTIONAL' WHEN NOT b.required AND c.required THEN 'OPTIONAL_MADE_REQUIRED' END AS change FROM b FULL JOIN c USING (topic, field) WHERE topic IN (SELECT topic FROM b) AND topic IN (SELECT topic FROM c)) WHERE change IS NOT NULL""")
def contract_drift(spark, d):
    """Drift between the contracts that the orders of each customer kept to before and after a date, read from the orders."""
    o = table(spark, d, "orders")
    field = lambda name, value: F.struct(name.alias("field"), value.cast("string").alias("value"))
    year = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice")).otherwise(F.year("o_orderdate"))
    fields = F.array(field(F.concat(F.lit("status_"), "o_orderstatus"), F.substring("o_orderpriority", 1, 1)), field(F.lit("total"), F.round("o_totalprice")), field(F.lit("year"), year))
    records = o.select((F.col("o_orderdate") >= F.lit(TURN)).alias("late"), F.concat(F.lit("cust_"), "o_custkey").alias("topic"), F.col("o_orderkey").alias("record_id"), F.explode(fields).alias("f")).select("late", "topic", "record_id", "f.*")
    return contracts.contract_drift(contracts.infer_contract(records.where("NOT late")), contracts.infer_contract(records.where("late")))


@query("SELECT customer_id, '<masked>' AS email, '<masked>' AS iban, country FROM cust WHERE country <> 'FRANCE'")
def masked_view(spark, d):
    return privacy.masked_view(adapters.customers(spark, d).select("customer_id", "email", "iban", "country"), ["email", "iban"], False, "country = 'FRANCE'")


@query("SELECT event_id, customer_id FROM order_kept")
def suppression_antijoin(spark, d):
    o, _, r = _base(spark, d)
    return not_suppressed(o, r).select("event_id", "customer_id")


# ---------------------------------------------------------------- incremental

#: Rows from here on count as new ones.
CUT = 883_612_800.0  # 1998-01-01


@query(f"SELECT customer_id FROM order_ev WHERE occurred_at > {CUT} UNION SELECT customer_id FROM zscore WHERE alerted_at > {CUT}")
def affected_customers(spark, d):
    o, p, _ = _base(spark, d)
    return incremental.affected_customers(incremental.changed_since(o, CUT, "occurred_at"), incremental.changed_since(fraud.zscore(p, parts=adapters.payment_parts(spark, d)), CUT, "alerted_at"))


@query("SELECT customer_id, country, email_hash, iban_hash, marketing_consent FROM s_customers")
def incremental_silver(spark, d):
    """Silver customers as of the cut, brought up to date: equal to the full build."""
    o, _, r = _base(spark, d)
    old = silver.silver_customers(o.where(F.col("occurred_at") <= CUT), r)
    affected = incremental.affected_customers(incremental.changed_since(o, CUT, "occurred_at"))
    return incremental.rebuild(old, o, affected, lambda rows: silver.silver_customers(rows, r), r)


@query("SELECT * FROM c360")
def incremental_gold(spark, d):
    o, _, r = _base(spark, d)
    build = lambda rows: gold.customer_360_from_orders(rows, r)
    affected = incremental.affected_customers(incremental.changed_since(o, CUT, "occurred_at"))
    return incremental.rebuild(build(o.where(F.col("occurred_at") <= CUT)), o, affected, build, r)


# ---------------------------------------------------------------- erasure, audit, tables


@query("SELECT e.event_id, e.customer_id, CASE WHEN r.customer_id IS NULL THEN e.email ELSE '<anonymized>' END AS email, CASE WHEN r.customer_id IS NULL THEN e.iban ELSE '<anonymized>' END AS iban, e.occurred_at FROM order_ev e LEFT JOIN requests r USING (customer_id)")
def erase_bronze_mask(spark, d):
    return erasure.mask(adapters.orders_placed(spark, d), _requests(spark, d), ["email", "iban"]).select("event_id", "customer_id", "email", "iban", "occurred_at")


@query("SELECT * FROM c360 WHERE customer_id NOT IN (SELECT customer_id FROM requests)")
def erase_gold(spark, d):
    return erasure.delete(_gold(spark, d), _requests(spark, d))


@query("SELECT customer_id, min(added_at) AS added_at FROM (SELECT customer_id, added_at FROM registry UNION ALL SELECT customer_id, requested_at FROM requests) GROUP BY customer_id")
def suppress_requests(spark, d):
    return suppress(adapters.suppression_registry(spark, d), _requests(spark, d).select("customer_id", F.col("requested_at").alias("added_at")))


@query("""SELECT q.customer_id, TRUE AS suppressed, 0 AS bronze_orders, coalesce(n, 0) AS gold_customer_360, 1 AS audits, coalesce(n, 0) = 0 AS passed FROM requests q LEFT JOIN (SELECT customer_id, count(*) AS n FROM c360 GROUP BY customer_id) USING (customer_id)""")
def verify_erasure(spark, d):
    """Bronze is masked and the registry written, but Gold is not yet rebuilt: the proof finds those rows."""
    req, reg = _requests(spark, d), adapters.suppression_registry(spark, d)
    after, registry, log = erasure.erase({"bronze.orders": adapters.orders_placed(spark, d)}, reg, req, NOW)
    return erasure.verify_erasure(req, registry, {**after, "gold.customer_360": _gold(spark, d)}, log)


@query("SELECT 'silver.orders' AS table_name, count(*) AS row_count, count(*) = 0 AS passed FROM s_orders JOIN requests USING (customer_id) UNION ALL SELECT 'gold.customer_360', count(*), count(*) = 0 FROM c360 WHERE customer_id IN (SELECT customer_id FROM requests) AND country <> 'FRANCE'")
def verify_refresh(spark, d):
    o, _, r = _base(spark, d)
    req = _requests(spark, d)
    return erasure.verify_refresh(req, {"silver.orders": silver.silver_orders(o, r), "gold.customer_360": erasure.delete(_gold(spark, d), req.join(adapters.customers(spark, d).where("country = 'FRANCE'").select("customer_id"), "customer_id", "left_semi")).where("country <> 'FRANCE'")})


@query("""SELECT alert_id, customer_id, rule, event_id, alerted_at + CASE WHEN rule = 'VELOCITY' THEN 5.0 ELSE 0.0 END AS alerted_at FROM alerts a WHERE rule IN ('VELOCITY', 'AMOUNT_ZSCORE') AND (rule = 'AMOUNT_ZSCORE' OR NOT EXISTS (SELECT 1 FROM registry r WHERE r.customer_id = a.customer_id))""")
def merge_alerts(spark, d):
    _, p, r = _base(spark, d)
    cols = ["alert_id", "customer_id", "rule", "event_id", "alerted_at"]
    # both rules from one pass, written once: the alerts are few, the payments are not
    found = written(fraud.all_alerts(p, BUCKET, rules=("VELOCITY", "AMOUNT_ZSCORE")).select(*cols), "alerts")
    old = found.where("rule = 'AMOUNT_ZSCORE'")
    batch = found.where("rule = 'VELOCITY'").withColumn("alerted_at", F.col("alerted_at") + 5.0)
    older = old.withColumn("alerted_at", F.col("alerted_at") - 1.0)
    return tables.merge_alerts(old, batch.unionByName(older).unionByName(batch), r)


@query("SELECT 'orders' AS table_name, count(*) AS rows_primary, count(*) AS rows_copy, count(*) = count(*) AS matches FROM orders UNION ALL SELECT 'customer', count(*), count(*) FILTER (c_custkey % 3 <> 0), count(*) = count(*) FILTER (c_custkey % 3 <> 0) FROM customer UNION ALL SELECT 'part', count(*), NULL, count(*) IS NULL FROM part")
def reconcile_tables(spark, d):
    o, c, p = (table(spark, d, t) for t in ("orders", "customer", "part"))
    return tables.reconcile({"orders": o, "customer": c, "part": p}, {"orders": o.repartition(3), "customer": c.where("c_custkey % 3 <> 0")})


@query("SELECT request_id, 'status' AS difference FROM audit_log WHERE customer_id LIKE '%107' UNION ALL SELECT request_id, 'MISSING_IN_CHAIN' FROM audit_log WHERE customer_id LIKE '%207'")
def audit_crosscheck(spark, d):
    log = _audit(spark, d)
    copy = log.where(~F.col("customer_id").like("%207")).withColumn("status", F.when(F.col("customer_id").like("%107"), "failed").otherwise(F.col("status")))
    return audit.cross_check(log, copy)


@query("""SELECT o_orderkey AS command_no, 'key-' || (o_orderkey // 3) AS idempotency_key, CASE WHEN n > 1 THEN 'conflict' WHEN kc IS NULL THEN 'new' WHEN kc <> o_custkey THEN 'conflict' ELSE 'replay' END AS outcome
    FROM (SELECT o.*, count(DISTINCT o_custkey) OVER (PARTITION BY o_orderkey // 3) AS n FROM orders o) o LEFT JOIN (SELECT o_orderkey // 3 AS k, o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS kc FROM orders WHERE o_orderkey % 6 = 0) s ON s.k = o.o_orderkey // 3""")
def replay_identity(spark, d):
    o = table(spark, d, "orders")
    key = F.concat(F.lit("key-"), F.floor(F.col("o_orderkey") / 3).cast("long"))
    incoming = o.select(F.col("o_orderkey").alias("command_no"), key.alias("idempotency_key"), F.col("o_custkey").alias("customer_id"), F.lit("t").alias("ticket_id"))
    state = o.where("o_orderkey % 6 = 0").select(key.alias("idempotency_key"), (F.col("o_custkey") + F.when(F.col("o_orderkey") % 4 == 0, 1).otherwise(0)).alias("customer_id"), F.lit("t").alias("ticket_id"), F.lit("completed").alias("status"))
    return erasure.replay_identity(incoming, state).select("command_no", "idempotency_key", "outcome")


@query("SELECT request_id, customer_id, CASE WHEN c_custkey % 3 = 0 THEN 'completed' ELSE 'pending' END AS status, requested_at FROM intake JOIN customer ON customer_id = 'cust_' || c_custkey")
def request_lifecycle(spark, d):
    req = _intake(spark, d).withColumn("requested_by", F.lit("dpo")).withColumn("reason", F.lit("GDPR_ARTICLE_17"))
    return erasure.request_lifecycle(req.unionByName(req.withColumn("requested_at", F.col("requested_at") - 5)), _audit(spark, d).where("int(substring(request_id, 5)) % 3 = 0")).select("request_id", "customer_id", "status", "requested_at")


# ---------------------------------------------------------------- stateful, chained, stored


@query(f"""SELECT shard, seq, 'HASH' AS problem FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY epoch(o_orderdate), request_id) AS seq FROM
    (SELECT *, 'req-' || o_orderkey AS request_id, CAST(CAST('0x' || substr(md5('req-' || o_orderkey), 1, 8) AS UBIGINT) % greatest(1, ceil(count(*) OVER () / {audit.SHARD_RECORDS})::BIGINT) AS INT) AS shard FROM orders)) WHERE o_orderkey % 500 = 0""")
def audit_chain_verify(spark, d):
    """Problems of a chain over all orders as audit records, with one record in 500 changed afterwards."""
    o = table(spark, d, "orders")
    log = o.select(F.concat(F.lit("req-"), "o_orderkey").alias("request_id"), F.concat(F.lit("cust_"), "o_custkey").alias("customer_id"), scalars.epoch_seconds("o_orderdate").alias("requested_at"), scalars.epoch_seconds("o_orderdate").alias("completed_at"), F.lit("gold.customer_360").alias("layers_touched"), F.lit("completed").alias("status"), F.lit("x").alias("confirmation_hash"))
    chain = audit.build_chain(log)
    hit = F.substring("request_id", 5, 20).cast("long") % 500 == 0
    changed = chain.withColumn("payload", F.when(hit, F.replace("payload", F.lit("completed\""), F.lit("failed\""))).otherwise(F.col("payload")))
    return audit.verify_chain(changed)


@query("""SELECT customer_id, 'VELOCITY' AS rule, CAST(rn AS DOUBLE) AS score, event_id, round(occurred_at, 3) AS alerted_at FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, floor(occurred_at / 86400) ORDER BY occurred_at, event_id) AS rn FROM event_pay) WHERE rn = 6
    UNION ALL SELECT customer_id, 'AMOUNT_ZSCORE', round(abs(amount_eur - mean) / sd, 3), event_id, round(occurred_at, 3) FROM (SELECT *, count(amount_eur) OVER w AS n, avg(amount_eur) OVER w AS mean, stddev_samp(amount_eur) OVER w AS sd FROM event_pay
        WINDOW w AS (PARTITION BY customer_id ORDER BY occurred_at, event_id ROWS BETWEEN 200 PRECEDING AND 1 PRECEDING)) WHERE n >= 3 AND sd > 0 AND abs(amount_eur - mean) / sd > 3
    UNION ALL SELECT customer_id, 'GEO_MISMATCH', 1.0, event_id, round(occurred_at, 3) FROM event_pay WHERE country <> merchant_country""")
def fraud_stream(spark, d):
    """Alerts of the stateful scorer over the whole events file as a stream."""
    from glasslake.streaming import fraud as stream

    root = f"{work_folder(spark)}/fraud-{uuid.uuid4().hex}"
    store = lake.Lake(spark, f"{root}/tables")
    registry = adapters.suppression_registry(spark, d)
    stream.run(stream.score(stream.event_payments(spark, d), registry, 86_400, expire=False), store, lambda: registry, f"{root}/checkpoint").awaitTermination()
    return store.read("bronze.fraud_alerts").select("customer_id", "rule", F.round("score", 3).alias("score"), "event_id", F.round("alerted_at", 3).alias("alerted_at"))


@query("SELECT 'silver.orders' AS table_name, count(*) AS row_count, count(*) > 0 AS passed FROM s_orders UNION ALL SELECT 'gold.customer_360', count(*), count(*) > 0 FROM c360")
def export_verify(spark, d):
    """Proof rows of a staged export of Silver orders and Gold customers."""
    o, _, r = _base(spark, d)
    store = lake.Lake(spark, f"{work_folder(spark)}/export-{uuid.uuid4().hex}")
    return tables.export_lake({"silver.orders": silver.silver_orders(o, r), "gold.customer_360": _gold(spark, d)}, store)


@query("""SELECT 'erasure_requests' AS topic, event_id AS "offset", props AS value FROM events WHERE event_type = 'error' AND event_id >= (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) FROM events WHERE event_type = 'error')""")
def dlq_requeue(spark, d):
    """The erasure intake after its dead letters were put back from the cursor on."""
    from glasslake.sources.topics import dead_letters, requeue

    dead = table(spark, d, "events").where("event_type = 'error'").select(F.lit("erasure_requests").alias("topic"), F.col("event_id").alias("offset"), F.col("props").alias("value"))
    cursor = dead.groupBy("topic").agg((F.max("offset") / 2).cast("long").alias("next_offset"))
    return requeue(dead.limit(0), dead_letters(dead, cursor), cursor)[0]


# ---------------------------------------------------------------- ingest, stored tables, jobs


def _order_log(spark, d):
    """Order records of a topic, each written three times; the copies differ in their offsets only."""
    rows = _json_orders(spark, d).select("o_orderkey", "value", F.explode(F.array(F.lit(2), F.lit(0), F.lit(1))).alias("copy"))
    return rows.select(F.lit("orders").alias("topic"), "value", (F.col("o_orderkey") % 3).cast("int").alias("partition"), (F.col("o_orderkey") * 10 + F.col("copy")).alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"))


@query("""SELECT 'ord-' || o_orderkey AS event_id, 'cust_' || o_custkey AS customer_id, o_totalprice AS amount_eur, o_orderkey * 10 AS first_offset FROM orders
    WHERE o_orderkey % 13 NOT BETWEEN 1 AND 6 AND 'cust_' || o_custkey NOT IN (SELECT customer_id FROM registry)""")
def load_bronze(spark, d):
    """Bronze orders of the whole log: the first record of each event."""
    from glasslake.sources.topics import load_bronze as load

    made = load(spark, _order_log(spark, d), adapters.suppression_registry(spark, d))["order_placed"]
    return made.select("event_id", "customer_id", "amount_eur", F.col("_kafka_offset").alias("first_offset"))


@query("""SELECT CASE o_orderkey % 13 WHEN 6 THEN 'JSON_PARSE_ERROR' WHEN 1 THEN 'EVENT_ID_MISSING' WHEN 2 THEN 'EVENT_TYPE_MISMATCH' WHEN 4 THEN 'REQUIRED_FIELD_MISSING' WHEN 5 THEN 'BUSINESS_RULE_FAILED' WHEN 3 THEN 'INVALID_OCCURRED_AT' END AS quarantine_reason, count(*) AS n, count(DISTINCT o_custkey) AS customers
    FROM orders WHERE o_orderkey % 13 BETWEEN 1 AND 6 AND 'cust_' || o_custkey NOT IN (SELECT customer_id FROM registry) GROUP BY 1""")
def ingest_quarantine(spark, d):
    """Quarantined order records by reason; ids are recovered from texts that cannot be read."""
    from glasslake.sources.topics import ingest

    bad = ingest(contracts.parse(_json_orders(spark, d).select("value"), "order_placed"), "order_placed", "log", adapters.suppression_registry(spark, d))[1]
    return bad.groupBy("quarantine_reason").agg(F.count("*").alias("n"), F.count_distinct("customer_id").alias("customers"))


def _store(spark, name):
    return lake.Lake(spark, f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}")


@query("SELECT o_custkey AS k, min(o_orderkey) FILTER (early) AS stored, coalesce(min(o_orderkey) FILTER (early), min(o_orderkey)) AS v FROM (SELECT *, o_orderdate < DATE '1995-06-01' AS early FROM orders) GROUP BY o_custkey")
def insert_ignore(spark, d):
    """The first order of each customer: a second write adds customers and leaves stored ones alone."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), "o_orderdate")
    store = _store(spark, "insert")
    store.insert_ignore("x.t", o.where("o_orderdate < '1995-06-01'").select("k", "v"), "k", [F.col("v")], "1")
    store.insert_ignore("x.t", o.select("k", "v"), "k", [F.col("v")], "2")
    return store.stored("x.t").select("k", F.when(F.col("_batch") == "1", F.col("v")).alias("stored"), "v")


@query("SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders GROUP BY o_custkey")
def replace_using(spark, d):
    """The last order of each customer, written in two halves."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"))
    store = _store(spark, "replace")
    store.replace_using("x.t", o.where("v % 2 = 0"), "k", [F.desc("v")])
    return store.replace_using("x.t", o.where("v % 2 = 1"), "k", [F.desc("v")])


@query(f"SELECT request_id, CASE WHEN c_custkey % 2 = 0 THEN {NOW}::DOUBLE + 9 ELSE {NOW}::DOUBLE END AS completed_at FROM audit_log JOIN customer ON customer_id = 'cust_' || c_custkey")
def append_audit(spark, d):
    """One attestation per request; a later one replaces the former."""
    log = _audit(spark, d)
    again = log.where("int(substring(request_id, 5)) % 2 = 0")
    new = again.withColumn("completed_at", F.lit(NOW + 9)).unionByName(again.withColumn("completed_at", F.lit(NOW + 3)))
    return erasure.append_audit(log, new).select("request_id", "completed_at")


@query("SELECT request_id, requested_at FROM intake JOIN customer ON customer_id = 'cust_' || c_custkey WHERE c_custkey % 3 <> 0 ORDER BY requested_at DESC, request_id LIMIT 20 OFFSET 10")
def request_page(spark, d):
    """The second page of the pending requests, newest first."""
    req = _intake(spark, d).withColumn("requested_by", F.lit("dpo")).withColumn("reason", F.lit("GDPR_ARTICLE_17"))
    life = erasure.request_lifecycle(req, _audit(spark, d).where("int(substring(request_id, 5)) % 3 = 0"))
    return erasure.filter_requests(life, "pending", limit=20, offset=10).select("request_id", "requested_at")


@query("""SELECT purge, count(*) AS n FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'FAILED' ELSE 'PENDING' END AS purge FROM customer) GROUP BY purge""")
def purge_status(spark, d):
    """How the data of all requests stand: completed, failed and still pending ones."""
    req = _intake(spark, d).withColumn("requested_by", F.lit("dpo")).withColumn("reason", F.lit("GDPR_ARTICLE_17"))
    k = F.substring("request_id", 5, 20).cast("long") % 4
    log = _audit(spark, d).where(k < 2).withColumn("status", F.when(k == 0, "completed").otherwise("failed"))
    life = erasure.request_lifecycle(req, log)
    return life.groupBy(scalars.purge_status("status", "completed_at").alias("purge")).agg(F.count("*").alias("n"))


@query("SELECT command_id, status FROM commands WHERE CAST(substr(command_id, 5) AS BIGINT) % 7 = 0 OR CAST(substr(command_id, 5) AS BIGINT) % 5 = 0")
def find_commands(spark, d):
    """Commands asked for by id or by idempotency key, each once."""
    state = _commands(spark, d).withColumn("idempotency_key", F.concat(F.lit("k"), "command_id"))
    k = F.substring("command_id", 5, 20).cast("long")
    wanted = state.select(F.when(k % 7 == 0, F.col("command_id")).alias("command_id"), F.when(k % 5 == 0, F.col("idempotency_key")).alias("idempotency_key"))
    return erasure.find_commands(state, wanted).select("command_id", "status")


@query(f"""SELECT command_id, CASE WHEN status = 'completed' THEN 'completed' WHEN k % 4 = 0 THEN 'completed' WHEN k % 4 = 3 THEN 'failed' ELSE 'running' END AS status, CASE WHEN k % 4 = 2 THEN 2 ELSE 1 END AS attempts,
    CASE WHEN k % 4 = 1 THEN 'gold' WHEN k % 4 = 3 THEN 'silver' END AS blocked_layer, CASE WHEN k % 4 = 0 AND {NOW} - requested_at > 60 THEN 'breached' WHEN k % 4 = 0 THEN 'met' WHEN {NOW} - requested_at > 60 THEN 'breached' ELSE 'open' END AS slo_state
    FROM (SELECT *, CAST(substr(command_id, 5) AS BIGINT) AS k FROM commands WHERE status = 'running')""")
def advance_commands(spark, d):
    """Running commands after one event each: proven completion, refused completion, restart, failure."""
    k = F.substring("command_id", 5, 20).cast("long") % 4
    text = lambda v=None: F.lit(v).cast("string")
    state = _commands(spark, d).where("status = 'running'").select(
        "command_id", "status", "requested_at", F.lit(1).alias("attempts"), F.lit(None).cast("double").alias("completed_at"), (k == 0).alias("logical_verified"), F.lit(True).alias("physical_verified"),
        F.lit(True).alias("export_verified"), text("r").alias("refresh_id"), text().alias("blocked_layer"), text().alias("failure_message"), text("open").alias("slo_state"),
    )
    event = F.when(k <= 1, "complete").when(k == 2, "start").otherwise("fail")
    events = state.select("command_id", event.alias("event"), F.when(k == 1, "gold").when(k == 3, "silver").alias("layer"), F.when(k == 3, "lost").alias("message"), F.lit(1.0).alias("at"))
    return erasure.advance(state, events, NOW).select("command_id", "status", "attempts", "blocked_layer", "slo_state")


@query("SELECT DISTINCT 'iban' AS column_name, 'IBAN' AS pii_tags FROM order_ev WHERE iban_ok")
def pii_unregistered(spark, d):
    """Personal columns of the orders that a manifest of their e-mail column does not name."""
    o = adapters.orders_placed(spark, d).select("email", "iban", "country", "order_id")
    manifest = privacy.build_manifest(o, "bronze.orders").where("column_name = 'email'")
    return privacy.detect_unregistered(o, "bronze.orders", manifest).select("column_name", F.array_join("detected", ",").alias("pii_tags"))


@query("SELECT customer_id, country, order_count, lifetime_spend_eur, consents_marketing FROM c360")
def incremental_job(spark, d):
    """customer_360 after a full run of the pipeline's builds up to a date and an incremental one for the rest."""
    from glasslake.plans import jobs

    o, p, r = _base(spark, d)
    store = _store(spark, "job")
    store.write("bronze.orders", o.where(F.col("occurred_at") <= CUT))
    store.write("bronze.payments", p.where(F.col("occurred_at") <= CUT), placed=True)
    jobs.build_silver(store, r)
    jobs.build_gold(store, r)
    jobs.mark_processed(store, jobs.pending(store))
    store.append("bronze.orders", o.where(F.col("occurred_at") > CUT))
    store.append("bronze.payments", p.where(F.col("occurred_at") > CUT), placed=True)
    jobs.build_incremental(store, r)
    return store.read("gold.customer_360").select("customer_id", "country", "order_count", "lifetime_spend_eur", "consents_marketing")


@query("SELECT customer_id, TRUE AS suppressed, count(*) * 0 AS bronze_orders, count(*) * 0 AS silver_orders, count(*) * 0 AS silver_orders_quarantine, count(*) * 0 AS gold_customer_360, count(DISTINCT request_id) AS audits, TRUE AS passed FROM requests GROUP BY customer_id")
def erasure_job(spark, d):
    """Proof of an erasure over stored tables, quarantine included."""
    o, _, r = _base(spark, d)
    req, store = _requests(spark, d), _store(spark, "erase")
    store.write("governance.suppression_registry", r)
    store.write("bronze.orders", o, placed=True)
    flagged = silver.flagged_stored(store.read("bronze.orders"), r, silver.order_flag)
    store.write("silver.orders", silver.orders_of(flagged), placed=True)
    store.write("silver.orders_quarantine", silver.bad_orders_of(flagged), placed=True)
    store.write("gold.customer_360", gold.customer_360_of(flagged))
    log = erasure.run_erasure(store, req, NOW)
    names = ["bronze.orders", "silver.orders", "silver.orders_quarantine", "gold.customer_360"]
    return erasure.verify_erasure(req, store.read("governance.suppression_registry"), {n: store.read(n) for n in names}, log)


@query("""SELECT customer_id, count(*) AS rows_before, 0 AS rows_after, TRUE AS passed FROM (
    SELECT 'cust_' || o_custkey AS customer_id, o_orderkey FROM orders WHERE o_orderkey % 5 <> 4 AND 'cust_' || o_custkey IN (SELECT customer_id FROM requests)
    UNION ALL SELECT 'cust_' || (o_custkey + 1), o_orderkey FROM orders WHERE o_orderkey % 5 = 3 AND 'cust_' || (o_custkey + 1) IN (SELECT customer_id FROM requests)) GROUP BY 1""")
def erase_payloads(spark, d):
    """Unreadable payloads that name a customer, before and after an erasure: cut behind the id, unquoted, with an empty value in
    front, naming two customers, and (not to be found) naming a longer id."""
    from glasslake.operators import payloads

    o = table(spark, d, "orders")
    one, two = F.concat(F.lit("cust_"), "o_custkey"), F.concat(F.lit("cust_"), F.col("o_custkey") + 1)
    kinds = [
        F.concat(F.lit('{"order":'), "o_orderkey", F.lit(',"customer_id":"'), one), F.concat(F.lit("order="), "o_orderkey", F.lit(" customer_id="), one, F.lit(" broken")),
        F.concat(F.lit('{"email":"","customer_id":"'), one, F.lit('","order":'), "o_orderkey"), F.concat(F.lit('["'), one, F.lit('","'), two, F.lit('",'), "o_orderkey"),
        F.concat(F.lit('{"customer_id":"'), one, F.lit('x","order":'), "o_orderkey"),
    ]
    kind = F.col("o_orderkey") % 5
    payload = F.coalesce(*[F.when(kind == k, c) for k, c in enumerate(kinds)])
    store, req = _store(spark, "payloads"), _requests(spark, d)
    store.write("governance.dead_letters", o.select(payload.alias("raw_payload"), F.lit("JSON_PARSE_ERROR").alias("quarantine_reason")))
    found = lambda: payloads.rows_of(store.read("governance.dead_letters"), req.select("customer_id").distinct()).groupBy(F.col("named").alias("customer_id"))
    store.write("governance.quality_results", found().agg(F.count("*").alias("rows_before")))
    erasure.run_erasure(store, req, NOW)
    after = found().agg(F.count("*").alias("n"))
    left = F.coalesce("n", F.lit(0)).cast("int")
    return store.read("governance.quality_results").join(after, "customer_id", "left").select("customer_id", "rows_before", left.alias("rows_after"), (left == 0).alias("passed"))


def _chain(spark, d):
    o = table(spark, d, "orders")
    at = scalars.epoch_seconds("o_orderdate")
    return audit.build_chain(o.select(F.concat(F.lit("req-"), "o_orderkey").alias("request_id"), F.concat(F.lit("cust_"), "o_custkey").alias("customer_id"), at.alias("requested_at"), at.alias("completed_at"), F.lit("gold.customer_360").alias("layers_touched"), F.lit("completed").alias("status"), F.lit("x").alias("confirmation_hash")))


@query(f"""SELECT shard, (seq - 1) // {audit.SEGMENT} AS segment, count(*) AS records, bool_and(o_orderkey % 500 <> 0) AS passed FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY epoch(o_orderdate), request_id) AS seq FROM
    (SELECT *, 'req-' || o_orderkey AS request_id, CAST(CAST('0x' || substr(md5('req-' || o_orderkey), 1, 8) AS UBIGINT) % greatest(1, ceil(count(*) OVER () / {audit.SHARD_RECORDS})::BIGINT) AS INT) AS shard FROM orders)) GROUP BY ALL""")
def audit_chain_segments(spark, d):
    """Which segments of a chain over all orders can be proved by their kept roots alone, one record in 500 changed afterwards."""
    chain = _chain(spark, d)
    roots = audit.segment_roots(chain)
    hit = F.substring("request_id", 5, 20).cast("long") % 500 == 0
    changed = chain.withColumn("payload", F.when(hit, F.replace("payload", F.lit("completed\""), F.lit("failed\""))).otherwise(F.col("payload")))
    proved = audit.verify_segments(changed, roots)
    return proved.join(roots.select("shard", "segment", "records"), ["shard", "segment"]).select("shard", "segment", "records", "passed")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'MISSING_IN_COPY' ELSE 'CHANGED' END AS difference FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 70 = 1
    UNION ALL SELECT -o_orderkey, 'MISSING_IN_PRIMARY' FROM orders WHERE o_orderkey % 90 = 2 UNION ALL SELECT o_orderkey, 'COUNT' FROM orders WHERE o_orderkey % 110 = 3 AND o_orderkey % 70 <> 1 AND o_orderkey % 50 <> 0""")
def reconcile_keys(spark, d):
    """Orders that a copy lacks, has besides, has twice or has with another status, found below differing nodes of two hash trees."""
    from glasslake.operators.difference import reconcile_keys as keys

    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    copy = o.where(k % 50 != 0).withColumn("o_orderstatus", F.when(k % 70 == 1, "changed").otherwise(F.col("o_orderstatus")))
    copy = copy.unionByName(o.where(k % 90 == 2).withColumn("o_orderkey", -k)).unionByName(o.where((k % 110 == 3) & (k % 70 != 1) & (k % 50 != 0)))
    return keys(o, copy, "o_orderkey")


@query("""SELECT o_orderkey, o_orderkey % 13 = 0 AS corrupt, CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS amount_eur,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 7 <> 0 END AS marketing_consent,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE nullif(concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'amount_eur' END, CASE WHEN o_orderkey % 5 = 0 THEN 'coupon' END, CASE WHEN o_orderkey % 11 = 0 THEN 'marketing_consent' END), '') END AS rescued FROM orders""")
def partner_rescued(spark, d):
    """Partner rows with a field beyond the contract, an amount or a consent as text, or a broken line: what is taken and what is rescued."""
    from glasslake.sources.topics import RESCUED, rescue

    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    parts = [
        F.concat(F.lit('{"event_id":"ord-'), k, F.lit('","event_type":"order_placed","order_id":"'), k, F.lit('","amount_eur":')),
        F.when(k % 7 == 0, F.concat(F.lit('"'), "o_totalprice", F.lit('"'))).otherwise(F.col("o_totalprice").cast("string")), F.when(k % 5 == 0, ',"coupon":{"code":7}').otherwise(""),
        F.lit(',"marketing_consent":'), F.when(k % 11 == 0, '"yes"').otherwise((k % 7 != 0).cast("string")), F.when(k % 13 == 0, "").otherwise("}"),
    ]
    rows = rescue(o.select("o_orderkey", F.concat(*parts).alias("value")), "order_placed")
    names = F.array_join(F.array_sort(F.map_keys(F.from_json(RESCUED, "map<string,string>"))), ",")
    return rows.select("o_orderkey", F.col(contracts.CORRUPT).isNotNull().alias("corrupt"), "amount_eur", "marketing_consent", names.alias("rescued"))


@query("SELECT customer_id, '<masked>@example.com' AS email, '<masked>' AS iban, country FROM cust WHERE NOT (c_custkey % 11 = 0) AND country <> 'GERMANY'")
def masked_sql(spark, d):
    """A statement over customers for a session without roles: masks and the row filter are SQL functions."""
    from glasslake.plans import sql

    sql.define_functions(spark)
    rows = adapters.customers(spark, d).select("customer_id", "email", "iban", "country", (F.col("c_custkey") % 11 == 0).alias("restricted"))
    view = sql.policy_view(spark, "crm.people", rows, sql.Policy({"email": "mask_email", "iban": "mask_pii"}, ("unrestricted", ("restricted",))))
    return sql.run_sql(spark, f"SELECT customer_id, email, iban, country FROM {view} WHERE country <> :country", {"country": "GERMANY"})


@query("""SELECT greatest(1.0, max(at_s)) AS window_end, count(*) FILTER (at_s >= e - 86400) AS requests, count(*) FILTER (at_s >= e - 86400 AND status >= 500) AS errors, round(1 - count(*) FILTER (at_s >= e - 86400 AND status >= 500) / count(*) FILTER (at_s >= e - 86400), 6) AS success_ratio,
    round(count(*) FILTER (at_s >= e - 86400 AND status >= 500) / count(*) FILTER (at_s >= e - 86400) / (1 - 0.99::DOUBLE), 4) AS burn_rate, round(greatest(0.0, least(1.0, 1 - count(*) FILTER (at_s >= e - 86400 AND status >= 500) / count(*) FILTER (at_s >= e - 86400) / (1 - 0.99::DOUBLE))), 4) AS budget_left
    FROM request_log, (SELECT max(at_s) AS e FROM request_log)""")
def slo_state(spark, d):
    """The error budget of the day that ends with the newest request."""
    return reports.slo_state(adapters.request_log(spark, d), 1.0)


@query("""SELECT phase, table_name, n - CASE WHEN phase = 'after' THEN lost ELSE 0 END AS row_count, phase = 'after' OR lost = 0 AS passed FROM (VALUES ('before'), ('after')) v(phase),
    (SELECT 'silver.orders' AS table_name, count(*) AS n, count(*) FILTER (customer_id IN (SELECT customer_id FROM requests)) AS lost FROM s_orders
    UNION ALL SELECT 'gold.customer_360', count(*), count(*) FILTER (customer_id IN (SELECT customer_id FROM requests)) FROM c360)""")
def export_erased(spark, d):
    """Whether an export holds erased customers: one made before their erasure, and one made after it."""
    o, _, r = _base(spark, d)
    source, out, req = _store(spark, "export-from"), _store(spark, "export-to"), _requests(spark, d)
    source.write("silver.orders", silver.silver_orders(o, r))
    source.write("gold.customer_360", _gold(spark, d))
    names, found = ["silver.orders", "gold.customer_360"], []
    for phase in ("before", "after"):
        if phase == "after":
            erasure.run_erasure(source, req, NOW)
        tables.export_lake({n: source.read(n) for n in names}, out)
        proof = tables.verify_export(out, {n: source.read(n) for n in names}, req).collect()  # one row for each table
        found += [(phase, p["table_name"], p["row_count"], p["passed"]) for p in proof]
    return spark.createDataFrame(found, "phase string, table_name string, row_count long, passed boolean")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'page_click' WHEN event_id % 3 = 1 THEN 'payment_processed' ELSE 'erasure_requested' END AS event_type,
    CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 5 = 0 THEN 'REQUIRED_FIELD_MISSING' END
    WHEN event_id % 3 = 1 THEN CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 'BUSINESS_RULE_FAILED' END
    ELSE CASE WHEN event_id % 5 = 0 THEN 'REQUIRED_FIELD_MISSING' WHEN event_id % 7 = 0 THEN 'BUSINESS_RULE_FAILED' END END AS reason FROM events""")
def contract_rules(spark, d):
    """The rules of clicks, payments and erasure requests: required fields, amounts, statuses and reasons."""
    e, k = table(spark, d, "events"), F.col("event_id")
    base = lambda kind: [F.concat(F.lit("e"), k).alias("event_id"), F.lit(kind).alias("event_type"), F.lit(5.0).alias("occurred_at"), F.concat(F.lit("cust_"), "user_id").alias("customer_id")]
    texts = lambda *names: [F.lit("x").alias(n) for n in names]
    bodies = {
        "page_click": [*texts("click_id", "session_id", "ip_address", "country"), F.when(k % 5 != 0, "/home").otherwise(" ").alias("page")],
        "payment_processed": [*texts("payment_id", "order_id", "iban", "country", "merchant_country"), F.when(k % 5 == 0, -1.0).otherwise(2.0).alias("amount_eur"), F.when(k % 7 == 0, "lost").when(k % 11 == 0, "captured").alias("status")],
        "erasure_requested": [F.when(k % 5 != 0, "r").alias("request_id"), F.when(k % 7 == 0, "WISH").when(k % 11 == 0, "GDPR_ARTICLE_17").alias("reason")],
    }
    from glasslake.sources.topics import flagged

    parts = []
    for n, (kind, body) in enumerate(bodies.items()):
        rows = e.where(k % 3 == n).select(F.to_json(F.struct(*base(kind), *body)).alias("value"))
        parts.append(flagged(contracts.parse(rows, kind), kind, "log").select(F.substring("event_id", 2, 20).cast("long").alias("event_id"), F.lit(kind).alias("event_type"), F.col("quarantine_reason").alias("reason")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT event_id FROM s_orders WHERE customer_id NOT IN (SELECT customer_id FROM requests)""")
def seed_lake(spark, d):
    """Silver orders of an empty lake that is filled from another one, without customers who have asked for erasure."""
    o, _, r = _base(spark, d)
    source, new = _store(spark, "seed-from"), _store(spark, "seed-to")
    source.write("silver.orders", silver.silver_orders(o, r))
    tables.seed_from_lake(new, source, ["silver.orders"], _requests(spark, d).select("customer_id"))
    tables.seed_from_lake(new, source, ["silver.orders"], r)  # not empty any more
    return new.read("silver.orders").select("event_id")


@query("""SELECT 'run-1' AS run_id, check_name, passed, bool_or(NOT passed) OVER () AS stopped
    FROM (SELECT 'unique:bronze.orders.event_id' AS check_name, count(*) = count(DISTINCT event_id) AS passed FROM order_ev
        UNION ALL SELECT 'suppression:bronze.orders', count(*) = 0 FROM order_ev JOIN registry USING (customer_id)
        UNION ALL SELECT 'suppression:silver.orders', count(*) = 0 FROM s_orders JOIN registry USING (customer_id)
        UNION ALL SELECT 'unreadable', FALSE)""")
def quality_run(spark, d):
    """All results of a run are stored before its gate stops it: a check that cannot be made is a failed one and hides no other."""
    o, _, r = _base(spark, d)
    store = _store(spark, "quality-run")
    checks = {
        "unreadable": lambda: quality.uniqueness(o, "no_such_column", "bronze.orders"),
        "unique": lambda: quality.uniqueness(o, "event_id", "bronze.orders"),
        "suppression": lambda: quality.suppression_enforced({"bronze.orders": o, "silver.orders": silver.silver_orders(o, r)}, r),
    }
    store.append("governance.quality_results", quality.run_checks(spark, checks, "run-1", NOW))
    stored, stopped = store.read("governance.quality_results"), False
    try:
        quality.gate(stored)
    except quality.QualityGateError:
        stopped = True
    return stored.select("run_id", "check_name", "passed", F.lit(stopped).alias("stopped"))


@query("SELECT 'orders' AS table_name, event_id, customer_id FROM order_ev UNION ALL SELECT 'payments', event_id, customer_id FROM pay_ev")
def bronze_read(spark, d):
    """Stored Bronze rows, written in two batches and read whole."""
    o, p, _ = _base(spark, d)
    store = _store(spark, "bronze-read")
    for name, rows in (("orders", o), ("payments", p)):
        store.append(f"bronze.{name}", rows.where(F.col("occurred_at") <= CUT), placed=True)
        store.append(f"bronze.{name}", rows.where(F.col("occurred_at") > CUT), placed=True)
    parts = [tables.read_bronze(store, n).select(F.lit(n).alias("table_name"), "event_id", "customer_id") for n in ("orders", "payments")]
    return parts[0].unionByName(parts[1])


@query("""SELECT 'order_placed' AS table_name, count(*) AS n FROM orders WHERE o_orderkey % 13 NOT BETWEEN 1 AND 6 AND 'cust_' || o_custkey NOT IN (SELECT customer_id FROM registry)
    UNION ALL SELECT 'quarantine', 3 * count(*) FROM orders WHERE o_orderkey % 13 IN (1, 3, 4, 5, 6) AND 'cust_' || o_custkey NOT IN (SELECT customer_id FROM registry)""")
def replay_log(spark, d):
    """Bronze rebuilt from the whole log: valid orders once each, rejected records as often as the log holds them."""
    from glasslake.sources.topics import replay

    log = _order_log(spark, d).where("coalesce(get_json_object(value, '$.event_type'), 'order_placed') = 'order_placed'")
    made, _ = replay(spark, log, adapters.suppression_registry(spark, d))
    return reports.table_counts({n: made[n] for n in ("order_placed", "quarantine")}).select("table_name", F.col("row_count").alias("n"))


@query("""SELECT 'orders' AS table_name, count(*) FILTER (customer_id IN (SELECT customer_id FROM requests)) AS held_before, 0 AS held_after, count(*) AS rows_after FROM order_ev
    UNION ALL SELECT 'silver_orders', count(*) FILTER (customer_id IN (SELECT customer_id FROM requests)), 0, count(*) FILTER (customer_id NOT IN (SELECT customer_id FROM requests)) FROM s_orders""")
def physical_scan(spark, d):
    """Rows of erased customers in every data file of two tables, before and after their erasure."""
    o, _, r = _base(spark, d)
    store, req, found = _store(spark, "scan"), _requests(spark, d), {}
    store.append("bronze.orders", o.where(F.col("occurred_at") <= CUT), placed=True)
    store.append("bronze.orders", o.where(F.col("occurred_at") > CUT), placed=True)
    store.write("silver.orders", silver.orders_of(silver.flagged_stored(store.read("bronze.orders"), r, silver.order_flag)), placed=True)
    held = lambda name: erasure.physical_scan(store, name, req).agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
    names = {"bronze.orders": "orders", "silver.orders": "silver_orders"}
    for name in names:
        found[name] = [held(name)]
    erasure.run_erasure(store, req, NOW)
    rows = [(short, *found[name], held(name), store.read(name).count()) for name, short in names.items()]
    return spark.createDataFrame(rows, "table_name string, held_before long, held_after int, rows_after long")


@query("""SELECT 'erased' AS kind, count(*) AS n FROM requests UNION ALL SELECT 'dead', count(*) FROM customer WHERE c_custkey % 100 = 8
    UNION ALL SELECT 'kept', count(*) FROM s_orders WHERE customer_id NOT IN (SELECT customer_id FROM requests)""")
def erasure_stream(spark, d):
    """The erasure intake as a stream of topic records in two offset ranges: who was erased, and what went to the dead letters."""
    from glasslake.sources import topics
    from glasslake.streaming import fraud as stream

    root = f"{work_folder(spark)}/intake-{uuid.uuid4().hex}"
    o, _, r = _base(spark, d)
    store, k = _store(spark, "intake"), F.col("c_custkey")
    store.write("silver.orders", silver.silver_orders(o, r))
    body = F.to_json(F.struct(F.concat(F.lit("e"), k).alias("event_id"), F.lit("erasure_requested").alias("event_type"), F.lit(5.0).alias("occurred_at"), F.concat(F.lit("req-"), k).alias("request_id"), F.concat(F.lit("cust_"), k).alias("customer_id")))
    value = F.when(k % 100 == 7, body).otherwise(F.concat(F.lit("{"), body))
    asked = table(spark, d, "customer").where("c_custkey % 100 IN (7, 8)")
    asked.select(F.lit("erasures").alias("topic"), value.alias("value"), (k % 2).cast("int").alias("partition"), k.cast("long").alias("offset")).write.json(f"{root}/topic")
    requests = topics.flagged(topics.read_topic(spark, "erasures", "erasure_requested", path=f"{root}/topic", starting={0: 0, 1: -2}), "erasure_requested", "topic")
    stream.run_erasures(requests, store, lambda: r, f"{root}/checkpoint", lambda lake, rows: erasure.run_erasure(lake, rows, NOW)).awaitTermination()
    one = lambda kind, rows: rows.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return one("erased", store.read("governance.erasure_audit_log")).unionByName(one("dead", store.read("governance.dead_letters"))).unionByName(one("kept", store.read("silver.orders")))
