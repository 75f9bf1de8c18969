"""Fraud rules in batch form: the specification that the stream equals on in-order input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from glasslake.functions.scalars import alert_id, alert_key, bucket_start
from glasslake.operators.ordered import by_key

#: Velocity threshold and window, z limit, baseline rows.
VELOCITY, WINDOW_S, Z_LIMIT, HISTORY, LEAST_HISTORY = 5, 300, 3.0, 200, 3
COLUMNS = ("alert_id", "customer_id", "rule", "score", "event_id", "alerted_at", "window_start", "window_end")


def _in_time() -> WindowSpec:
    return Window.partitionBy("customer_id").orderBy("occurred_at", "event_id")


def _alerts(df: DataFrame, rule: str, size: int | None) -> DataFrame:
    start = bucket_start("occurred_at", size) if size else F.lit(None).cast("long")
    end = start + size if size else F.lit(None).cast("long")
    found = df.withColumn("rule", F.lit(rule)).withColumn("window_start", start).withColumn("window_end", end).withColumn("alerted_at", F.col("occurred_at"))
    return found.withColumn("alert_id", alert_id("rule", "customer_id", "event_id", "window_start", "window_end")).select(*COLUMNS)


def velocity(payments: DataFrame, size: int = WINDOW_S, threshold: int = VELOCITY) -> DataFrame:
    """The payment that first exceeds the threshold in a customer's tumbling window."""
    w = Window.partitionBy("customer_id", "bucket").orderBy("occurred_at", "event_id")
    hit = payments.withColumn("bucket", bucket_start("occurred_at", size)).withColumn("nth", F.row_number().over(w)).where(F.col("nth") == threshold + 1)
    return _alerts(hit.withColumn("score", F.col("nth").cast("double")), "VELOCITY", size)


def _baseline() -> dict[str, Column]:
    """Number, mean and spread of the customer's previous 200 amounts."""
    w = _in_time().rowsBetween(-HISTORY, -1)
    return {"n": F.count("amount_eur").over(w), "mean": F.avg("amount_eur").over(w), "sd": F.stddev_samp("amount_eur").over(w)}


def zscore(payments: DataFrame, limit: float = Z_LIMIT, parts: int | None = None) -> DataFrame:
    """Payments beyond the limit of the customer's previous 200 payments (three at least, spread above zero)."""
    base = by_key(payments.select("customer_id", "event_id", "occurred_at", "amount_eur"), parts, "customer_id").withColumns(_baseline())
    hit = base.where((F.col("n") >= LEAST_HISTORY) & (F.col("sd") > 0)).withColumn("score", F.abs(F.col("amount_eur") - F.col("mean")) / F.col("sd")).where(F.col("score") > limit)
    return _alerts(hit, "AMOUNT_ZSCORE", None)


def geo_mismatch(payments: DataFrame, scope: str = "event", size: int = WINDOW_S, own: str = "country", other: str = "merchant_country") -> DataFrame:
    """Payments to a merchant of another country: each, or the first of a customer's window."""
    hit = payments.where(F.col(own) != F.col(other)).withColumn("score", F.lit(1.0))
    if scope == "window":
        w = Window.partitionBy("customer_id", "bucket").orderBy("occurred_at", "event_id")
        hit = hit.withColumn("bucket", bucket_start("occurred_at", size)).withColumn("nth", F.row_number().over(w)).where("nth = 1")
    return _alerts(hit, "GEO_MISMATCH", size if scope == "window" else None)


#: The rules by name, in the order of their alerts.
RULES = ("VELOCITY", "AMOUNT_ZSCORE", "GEO_MISMATCH")


def all_alerts(payments: DataFrame, size: int = WINDOW_S, scope: str = "event", own: str = "country", other: str = "merchant_country", rules: tuple[str, ...] = RULES, parts: int | None = None, hashed: bool = True) -> DataFrame:
    """The alerts of velocity, zscore and geo_mismatch from one pass: payments are shuffled once, by customer, with the
    columns that the rules need, and sorted once. In the order of time a customer's rows of one bucket follow each other, so
    places in a bucket are read off the rows before, and no window by bucket sorts the rows again. parts as in by_key.
    hashed: without it alert_id is the key itself, which tells alerts apart as well where they are only counted.
    """
    abroad = F.coalesce(F.col(own) != F.col(other), F.lit(False)) if "GEO_MISMATCH" in rules else F.lit(False)
    seen = by_key(payments.select("customer_id", "event_id", "occurred_at", "amount_eur", abroad.alias("abroad")), parts, "customer_id")
    seen = seen.withColumn("bucket", bucket_start("occurred_at", size))
    none, place = F.lit(None).cast("long"), F.struct("bucket")
    alert = lambda rule, score, b: F.struct(F.lit(rule).alias("rule"), score.alias("score"), b.alias("window_start"), (b + size).alias("window_end"))
    here = lambda c: F.col(c).isNotNull() & F.col(f"{c}.bucket").eqNullSafe(F.col("bucket"))
    made, found = {}, []
    if "AMOUNT_ZSCORE" in rules:
        made |= _baseline()
        score = F.abs(F.col("amount_eur") - F.col("mean")) / F.col("sd")
        found.append(F.when((F.col("n") >= LEAST_HISTORY) & (F.col("sd") > 0) & (score > Z_LIMIT), alert("AMOUNT_ZSCORE", score, none)))
    if "VELOCITY" in rules:
        made |= {"last_allowed": F.lag(place, VELOCITY).over(_in_time()), "one_more": F.lag(place, VELOCITY + 1).over(_in_time())}
        found.append(F.when(here("last_allowed") & ~here("one_more"), alert("VELOCITY", F.lit(VELOCITY + 1.0), F.col("bucket"))))
    if "GEO_MISMATCH" in rules:
        hit = F.col("abroad")
        if scope == "window":
            made["abroad_before"] = F.last(F.when(F.col("abroad"), place), True).over(_in_time().rowsBetween(Window.unboundedPreceding, -1))
            hit = hit & ~here("abroad_before")
        found.append(F.when(hit, alert("GEO_MISMATCH", F.lit(1.0), F.col("bucket") if scope == "window" else none)))
    seen = seen.withColumns(made)
    # a filter of the array by a lambda would be interpreted: all are laid out, and those that are none go
    hits = seen.select("customer_id", "event_id", F.col("occurred_at").alias("alerted_at"), F.explode(F.array(*found)).alias("a")).where("a is not null").select("customer_id", "event_id", "alerted_at", "a.*")
    return hits.withColumn("alert_id", (alert_id if hashed else alert_key)("rule", "customer_id", "event_id", "window_start", "window_end")).select(*COLUMNS)
