"""The event model over the given star-schema tables; each relation is also given as SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glasslake.functions.scalars import epoch_seconds
from glasslake.operators.ordered import by_key, parts_of
from glasslake.operators.suppression import sized


#: A column that the event_id of a payment fixes, and by which payments_processed leaves its rows together.
PAYMENT_WITHIN = "order_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customer_columns() -> dict[str, Column]:
    """customer_id, email and iban from c_custkey and c_name; every eleventh IBAN has a wrong check digit."""
    bban = F.lpad(F.col("c_custkey").cast("string"), 18, "0")
    check = 98 - F.concat(bban, F.lit("131400")).cast("decimal(38,0)") % 97
    wrong = F.when(F.col("c_custkey") % 11 == 0, 1).otherwise(0)
    return {
        "customer_id": F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")), "email": F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")),
        "iban": F.concat(F.lit("DE"), F.lpad((check.cast("int") + wrong).cast("string"), 2, "0"), bban),
    }


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, email, iban, country; every eleventh IBAN has a wrong check digit."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    own = _customer_columns()
    # nation has 25 rows by its specification
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", *[v.alias(k) for k, v in own.items()], F.col("n_name").alias("country"), F.col("n_regionkey").alias("region"))


def orders_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events; every twentieth order is sent again a minute later with the same event_id."""
    o = table(spark, sf_dir, "orders")
    again = F.when(F.col("o_orderkey") % 20 == 0, F.array(F.lit(0), F.lit(60))).otherwise(F.array(F.lit(0)))
    return (
        o.withColumn("late", F.explode(again))
        .join(customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("event_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            "customer_id", "email", "iban", "country",
            F.col("o_totalprice").alias("amount_eur"),
            (F.col("o_orderkey") % 7 != 0).alias("marketing_consent"),
            F.lit("EUR").alias("currency"),
            (epoch_seconds("o_orderdate") + F.col("late")).alias("occurred_at"),
        )
    )


def payment_parts(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions that a shuffle of payments needs, as parts_of."""
    return parts_of(table(spark, sf_dir, "lineitem"))


def payments_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment events from order lines: billing country of the customer, merchant country of the supplier.

    Order lines are shuffled once, by order_id, as keys and numbers; ids, IBANs and names are made behind the joins.
    """
    line, o, c, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "nation"))
    nation = lambda key, name, region: F.broadcast(n.select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name), F.col("n_regionkey").alias(region)))
    buyer = o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").cast("string").alias("order_id"), "c_custkey", "c_nationkey")
    lines = by_key(line.withColumn("order_id", F.col("l_orderkey").cast("string")).drop("l_orderkey"), payment_parts(spark, sf_dir), "order_id")
    own = _customer_columns()
    status = F.when(F.col("l_returnflag") == "A", "authorized").when(F.col("l_returnflag") == "R", "declined").otherwise("captured")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (
        lines.join(buyer, "order_id")
        .join(sized(s.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")), "l_suppkey")
        .join(nation("c_nationkey", "country", "region"), "c_nationkey")
        .join(nation("s_nationkey", "merchant_country", "merchant_region"), "s_nationkey")
        .select(
            F.concat_ws("-", F.lit("pay"), "order_id", "l_linenumber", "l_partkey", "l_suppkey", cents).alias("event_id"),
            F.concat_ws("-", "order_id", "l_linenumber").alias("payment_id"),
            "order_id", own["customer_id"].alias("customer_id"), own["iban"].alias("iban"), "country", "merchant_country", "region", "merchant_region",
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount_eur"),
            status.alias("status"),
            epoch_seconds("l_shipdate").alias("occurred_at"),
        )
    )


def page_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    ip = F.concat_ws(".", F.lit("10"), F.col("event_id") % 250, F.floor(F.col("event_id") / 250) % 250, F.col("user_id") % 250)
    return e.select(F.concat(F.lit("clk-"), "event_id").alias("event_id"), F.col("event_id").cast("string").alias("click_id"), F.concat(F.lit("cust_"), "user_id").alias("customer_id"), ip.alias("ip_address"), F.col("event_type").alias("page"), epoch_seconds("ts").alias("occurred_at"))


def suppression_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_custkey % 50 = 0")
    return c.select(F.concat(F.lit("cust_"), "c_custkey").alias("customer_id"), F.lit(0.0).alias("added_at"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request log for service levels: errors are 5xx."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", epoch_seconds("ts").alias("at_s"), F.when(F.col("event_type") == "error", 503).otherwise(200).alias("status"), F.col("event_type").alias("endpoint"), F.col("value").alias("latency_ms"))


#: The same relations as SQL, by name; each may use those above it.
SQL = {
    "cust": """
        SELECT c_custkey, 'cust_' || c_custkey AS customer_id, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               'DE' || lpad(CAST(98 - CAST(lpad(CAST(c_custkey AS VARCHAR), 18, '0') || '131400' AS HUGEINT) % 97
                   + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 18, '0') AS iban,
               c_custkey % 11 <> 0 AS iban_ok, n_name AS country, n_regionkey AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "order_ev": """
        SELECT 'ord-' || o_orderkey AS event_id, CAST(o_orderkey AS VARCHAR) AS order_id, customer_id, email, iban, iban_ok, country,
               o_totalprice AS amount_eur, o_orderkey % 7 <> 0 AS marketing_consent, 'EUR' AS currency,
               epoch(o_orderdate) + late AS occurred_at
        FROM orders JOIN cust ON o_custkey = c_custkey JOIN (VALUES (0), (60)) d(late) ON late = 0 OR o_orderkey % 20 = 0""",
    "pay_ev": """
        SELECT concat_ws('-', 'pay', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS event_id,
               concat_ws('-', l_orderkey, l_linenumber) AS payment_id, CAST(l_orderkey AS VARCHAR) AS order_id, customer_id, iban, iban_ok, country,
               n_name AS merchant_country, region, n_regionkey AS merchant_region, l_extendedprice * (1 - l_discount) AS amount_eur,
               CASE l_returnflag WHEN 'A' THEN 'authorized' WHEN 'R' THEN 'declined' ELSE 'captured' END AS status, epoch(l_shipdate) AS occurred_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "click_ev": """
        SELECT 'clk-' || event_id AS event_id, CAST(event_id AS VARCHAR) AS click_id, 'cust_' || user_id AS customer_id,
               concat_ws('.', '10', event_id % 250, (event_id // 250) % 250, user_id % 250) AS ip_address, event_type AS page, epoch(ts) AS occurred_at
        FROM events WHERE event_type IN ('click', 'view')""",
    "registry": "SELECT 'cust_' || c_custkey AS customer_id, 0.0::DOUBLE AS added_at FROM customer WHERE c_custkey % 50 = 0",
    "request_log": "SELECT event_id, epoch(ts) AS at_s, CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS status, event_type AS endpoint, value AS latency_ms FROM events",
}
