"""The fraud scorer as one keyed stateful pass over the payment stream.

State per customer, in RocksDB, as lists and maps that are added to and not written anew:

- the ids of past events and the amounts of past payments (lists; each is cut back when it is twice as long as it must be);
- the counts of the last windows (a map by the window's start). A window is closed once the customer has an event WINDOWS
  windows later: a late event neither opens it again nor pushes a newer one out;
- whether the customer is suppressed. Erasure requests can come as a stream of their own: they are keyed like payments, so
  a request stops the customer's next payment, and forgets what the state held, without a look at the registry. The
  registry as it is at the start is the initial state.

A customer's rows of a micro-batch are scored together with numpy. A timer in event time forgets customers without payments
for a day behind the watermark. On in-order input the alerts are those of glasslake.operators.fraud; a late payment is
scored against the history held at that time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from glasslake.functions.scalars import alert_id
from glasslake.operators.fraud import COLUMNS, HISTORY, LEAST_HISTORY, VELOCITY, WINDOW_S, Z_LIMIT
from glasslake.operators.suppression import not_suppressed
from glasslake.sources.lake import Lake
from glasslake.sources.tables import upsert_alerts

#: Event ids and windows that are remembered, life of a customer's state.
SEEN, WINDOWS, TTL_MS = 2048, 4, 86_400_000
#: How far a payment may come behind the newest one.
LATENESS = "30 days"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = T.StructType([T.StructField(n, t) for n, t in (("customer_id", T.StringType()), ("rule", T.StringType()), ("score", T.DoubleType()), ("event_id", T.StringType()), ("alerted_at", T.DoubleType()), ("window_start", T.LongType()), ("window_end", T.LongType()))])
PAYMENT = ["customer_id", "event_id", "occurred_at", "amount_eur", "country", "merchant_country"]


def z_scores(amounts: np.ndarray, known: int) -> np.ndarray:
    """|z| of each amount from number `known` on against the up to HISTORY amounts before it; 0 where these are too few or alike.

    Sums of all stretches come from running sums of the centred amounts.
    """
    centred = amounts - (amounts.mean() if len(amounts) else 0.0)
    first, second = (np.append(0.0, np.cumsum(x)) for x in (centred, centred * centred))
    changes = np.append(0, np.cumsum(amounts[1:] != amounts[:-1]))
    at = np.arange(known, len(amounts))
    low = np.maximum(at - HISTORY, 0)
    n = at - low
    enough = n >= LEAST_HISTORY
    enough[enough] = changes[at[enough] - 1] > changes[low[enough]]
    out = np.zeros(len(at))
    i, j, m = at[enough], low[enough], n[enough]
    mean = (first[i] - first[j]) / m
    spread = np.sqrt(np.maximum((second[i] - second[j]) - m * mean * mean, 0.0) / (m - 1))
    out[enough] = np.divide(np.abs(centred[i] - mean), spread, out=np.zeros(len(i)), where=spread > 0)
    return out


def score_rows(rows: pd.DataFrame, amounts: np.ndarray, windows: dict[int, tuple[int, bool]], size: int, geo_scope: str) -> tuple[list[tuple], np.ndarray, dict[int, tuple[int, bool]]]:
    """(alerts, amounts, windows) after one customer's new rows, sorted by time and id.

    windows: start -> (events so far, whether a mismatch was told).
    """
    at, ids = rows["occurred_at"].to_numpy(np.float64), rows["event_id"].to_numpy()
    start = (np.floor_divide(at, size) * size).astype(np.int64)
    open_from = max(windows, default=int(start[0])) - WINDOWS * size
    live = start > open_from
    starts, first, inverse, added = np.unique(start, return_index=True, return_inverse=True, return_counts=True)
    held = [windows.get(w, (0, False)) for w in starts.tolist()]
    before = np.array([n for n, _ in held], np.int64)
    rank = np.arange(len(at)) - first[inverse] + 1 + before[inverse]
    alerts = [("VELOCITY", float(rank[k]), ids[k], at[k], int(start[k]), int(start[k]) + size) for k in np.flatnonzero(live & (rank == VELOCITY + 1))]
    amount = rows["amount_eur"].to_numpy(np.float64)
    paid = np.flatnonzero(~np.isnan(amount))
    amounts = np.concatenate([amounts, amount[paid]])
    z = z_scores(amounts, len(amounts) - len(paid))
    alerts += [("AMOUNT_ZSCORE", float(z[k]), ids[paid[k]], at[paid[k]], None, None) for k in np.flatnonzero(z > Z_LIMIT)]
    here, there = rows["country"].to_numpy(object), rows["merchant_country"].to_numpy(object)
    apart = np.array([a is not None and b is not None and a == a and b == b and a != b for a, b in zip(here, there, strict=True)], bool)
    told = np.array([t for _, t in held], bool)
    if geo_scope == "event":
        alerts += [("GEO_MISMATCH", 1.0, ids[k], at[k], None, None) for k in np.flatnonzero(apart)]
    else:
        hits = np.flatnonzero(apart & live & ~told[inverse])
        _, once = np.unique(start[hits], return_index=True)
        alerts += [("GEO_MISMATCH", 1.0, ids[k], at[k], int(start[k]), int(start[k]) + size) for k in hits[once]]
    told |= np.bincount(inverse, weights=apart, minlength=len(starts)) > 0
    after = windows | {w: (int(n + m), bool(t)) for w, n, m, t, ok in zip(starts.tolist(), before, added, told, live[first], strict=True) if ok}
    newest = max(after, default=0)
    return alerts, amounts[-HISTORY:], {w: v for w, v in after.items() if w > newest - WINDOWS * size}


class FraudScorer(StatefulProcessor):
    """Pandas form; rows have the columns of PAYMENT and `gone` (true: an erasure request)."""

    def __init__(self, size: int = WINDOW_S, geo_scope: str = "event", ttl_ms: int | None = None) -> None:
        self.size, self.geo_scope, self.ttl_ms = size, geo_scope, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "event_id string")
        self.amounts = handle.getListState("amounts", "amount double")
        self.windows = handle.getMapState("windows", "start long", "n long, told boolean")
        self.gone = handle.getValueState("gone", "gone boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.gone.update((True,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.gone.exists():
            return
        batch = pd.concat(list(rows), ignore_index=True)
        if batch["gone"].any():
            self._forget()
            self.gone.update((True,))
            return
        seen = [r[0] for r in self.seen.get()]
        order = np.lexsort((batch["event_id"].to_numpy(str), batch["occurred_at"].to_numpy()))
        batch = batch.iloc[order].drop_duplicates("event_id")
        batch = batch[~batch["event_id"].isin(set(seen))]
        if batch.empty:
            return
        amounts = np.array([r[0] for r in self.amounts.get()], np.float64)
        windows = {k[0]: (v[0], v[1]) for k, v in self.windows.iterator()}
        alerts, _, after = score_rows(batch, amounts[-HISTORY:], windows, self.size, self.geo_scope)
        self._add(self.seen, seen, batch["event_id"].tolist(), SEEN)
        self._add(self.amounts, amounts.tolist(), batch["amount_eur"].dropna().tolist(), HISTORY)
        for w in windows.keys() - after.keys():
            self.windows.removeKey((w,))
        for w, v in after.items():
            if windows.get(w) != v:
                self.windows.updateValue((w,), v)
        if self.ttl_ms is not None and next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer(int(batch["occurred_at"].max() * 1000) + self.ttl_ms)
        if alerts:
            out = pd.DataFrame(alerts, columns=OUTPUT.fieldNames()[1:]).astype({"window_start": "Int64", "window_end": "Int64"})
            out.insert(0, "customer_id", key[0])
            yield out

    @staticmethod
    def _add(state, held: list, new: list, keep: int) -> None:
        """Add to a list; one of twice the length that is needed is written anew."""
        if len(held) + len(new) > 2 * keep:
            state.put([(x,) for x in (held + new)[-keep:]])
        elif new:
            state.appendList([(x,) for x in new])

    def _forget(self) -> None:
        for state in (self.seen, self.amounts, self.windows):
            state.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A day behind the payment that set the timer: forget the customer, or wait for a day behind the newest window."""
        newest = max((k[0] + self.size for k in self.windows.keys()), default=0) * 1000 + self.ttl_ms
        if newest > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(newest)
        else:
            self._forget()
        return iter(())

    def close(self) -> None:
        pass


def score(payments: DataFrame, registry: DataFrame, size: int = WINDOW_S, geo_scope: str = "event", expire: bool = True, tombstones: DataFrame | None = None) -> DataFrame:
    """Alerts of a payment stream; suppressed customers are dropped before they are scored.

    tombstones(customer_id, occurred_at) is a stream of erasure requests: with it the registry is read once, as the
    initial state. expire forgets customers by event time, so payments behind the watermark are dropped.
    """
    spark = payments.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = payments.select(*PAYMENT, F.lit(False).alias("gone"))
    if tombstones is None:
        rows = not_suppressed(rows, registry)
    else:
        asked = tombstones.where("customer_id is not null").select("customer_id", F.lit(None).cast("string").alias("event_id"), F.col("occurred_at").cast("double").alias("occurred_at"), F.lit(True).alias("gone"))
        rows = rows.unionByName(asked, allowMissingColumns=True)
    if expire:
        rows = rows.withColumn("at", F.timestamp_seconds("occurred_at")).withWatermark("at", LATENESS)
    initial = registry.select("customer_id").distinct().groupBy("customer_id") if tombstones is not None else None
    scorer = FraudScorer(size, geo_scope, TTL_MS if expire else None)
    scored = rows.groupBy("customer_id").transformWithStateInPandas(scorer, OUTPUT, "Append", "EventTime" if expire else "None", initialState=initial)
    return scored.withColumn("alert_id", alert_id("rule", "customer_id", "event_id", "window_start", "window_end")).select(*COLUMNS)


def velocity_stream(payments: DataFrame, size: int = WINDOW_S, watermark: str = "10 minutes") -> DataFrame:
    """The velocity rule without custom state: counts per tumbling event-time window, late rows behind the watermark dropped."""
    at = payments.withColumn("at", F.timestamp_seconds("occurred_at")).withWatermark("at", watermark)
    counts = at.groupBy("customer_id", F.window("at", f"{size} seconds").alias("w")).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > VELOCITY).select("customer_id", F.unix_timestamp("w.start").alias("window_start"), "n")


def run(alerts: DataFrame, lake: Lake, registry, checkpoint: str, table: str = "bronze.fraud_alerts", available_now: bool = True):
    """Write alerts by key: a retried micro-batch changes nothing; the registry is read again for each batch."""

    def batch(df: DataFrame, number: int) -> None:
        df.persist()
        upsert_alerts(lake, table, df, registry(), f"fraud-{number:012d}")
        df.unpersist()

    w = alerts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def run_erasures(requests: DataFrame, lake: Lake, registry, checkpoint: str, erase):
    """The erasure intake as a stream: readable requests are erased as a set, the others go to the dead letters."""

    def batch(df: DataFrame, number: int) -> None:
        df.persist()
        bad = df.where("_is_malformed")
        good = df.where("NOT _is_malformed").select("request_id", "customer_id", F.col("occurred_at").alias("requested_at"))
        if not bad.isEmpty():
            lake.append("governance.dead_letters", bad.select("raw_payload", "quarantine_reason"), f"erasures-{number:012d}")
        if not good.isEmpty():
            erase(lake, good)
        df.unpersist()

    return requests.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True).start()


def event_payments(spark: SparkSession, sf_dir: str, stream: bool = True) -> DataFrame:
    """Payments with real times from the events table, as a stream of its file or as a batch."""
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    reader = (spark.readStream if stream else spark.read).schema(schema)
    raw = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir) if stream else reader.parquet(f"{sf_dir}/events.parquet")
    return raw.select(
        F.concat(F.lit("cust_"), F.col("user_id")).alias("customer_id"), F.col("event_id").cast("string").alias("event_id"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("occurred_at"),
        F.col("value").alias("amount_eur"), (F.col("user_id") % 5).cast("string").alias("country"), (F.col("event_id") % 7).cast("string").alias("merchant_country"),
    )
