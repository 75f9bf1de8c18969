"""A tamper-evident copy of the audit log: each record carries the hash of the one before it.

A chain is sequential, so it is sharded by request: each shard is folded in order on its own. One shard gives the plain
chain. Verification recomputes all hashes in parallel and checks links range by range, for shards of any length; roots of
segments prove a range without the rest.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasslake.functions.scalars import canonical_json, chain_hash
from glasslake.operators.ordered import with_previous

GENESIS = "0" * 64
FIELDS = ["request_id", "customer_id", "requested_at", "completed_at", "layers_touched", "status", "confirmation_hash"]


def with_payload(audit: DataFrame) -> DataFrame:
    """The canonical payload of each record: sorted keys, numeric times, layers as one sorted text."""
    layers = F.array_join(F.array_sort(F.split("layers_touched", ",")), ",")
    return audit.withColumn("layers_touched", layers).withColumns({c: F.col(c).cast("double") for c in ("requested_at", "completed_at")}).withColumn("payload", canonical_json(FIELDS))


def _link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards one after the other, each in order; only the last record of a batch is handed to the next batch."""
    shard, seq, prev = None, 0, GENESIS
    for pdf in batches:
        rows = []
        for own_shard, request, payload in zip(pdf["shard"], pdf.request_id, pdf.payload, strict=True):
            if own_shard != shard:
                shard, seq, prev = own_shard, 0, GENESIS
            seq += 1
            own = hashlib.sha256(f"{seq}\n{prev}\n{payload}".encode()).hexdigest()
            rows.append((int(shard), seq, prev, own, request, payload))
            prev = own
        yield pd.DataFrame(rows, columns=["shard", "seq", "prev_hash", "hash", "request_id", "payload"])


#: Records of a shard; a shard is folded in one task.
SHARD_RECORDS = 100_000


def shard_of(request: str, shards: int) -> Column:
    """The shard of a request: the first 32 bits of its MD5, modulo the number of shards."""
    return F.pmod(F.conv(F.substring(F.md5(request), 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def build_chain(audit: DataFrame, shards: int | None = None) -> DataFrame:
    """shard, seq, prev_hash, hash, request_id, payload; a shard holds the records of one erasure log slice.

    The number of shards grows with the log, so that each holds some SHARD_RECORDS records.
    """
    if shards is None:
        shards = max(1, -(-audit.count() // SHARD_RECORDS))
    rows = with_payload(audit).withColumn("shard", shard_of("request_id", shards)).select("shard", "request_id", "completed_at", "payload")
    # a worker sees a shard as a stream of sorted batches and never holds it as a whole
    placed = rows.repartition("shard").sortWithinPartitions("shard", F.asc_nulls_last("completed_at"), F.asc_nulls_last("request_id"))
    return placed.mapInPandas(_link, "shard int, seq long, prev_hash string, hash string, request_id string, payload string")


def verify_chain(chain: DataFrame) -> DataFrame:
    """shard, seq, problem of every record that does not hold: HASH, LINK, SEQUENCE, MALFORMED, DUPLICATE_ID.

    A shard may be as long as the log: it is checked in ranges, and each range hands its last record to the next.
    """
    repeated = chain.groupBy("shard", "request_id").agg(F.count("*").alias("times")).where("times > 1")
    seen = with_previous(chain, ["shard"], ["seq", "hash"], ["hash", "seq"], "chain")
    same = F.col("a.shard").eqNullSafe(F.col("b.shard")) & F.col("a.request_id").eqNullSafe(F.col("b.request_id"))
    seen = seen.alias("a").join(repeated.alias("b"), same, "left").select("a.*", "times")
    problems = F.array(
        F.when(F.get_json_object("payload", "$.request_id").isNull(), F.lit("MALFORMED")),
        F.when(~chain_hash("seq", "prev_hash", "payload").eqNullSafe(F.col("hash")), F.lit("HASH")),
        F.when(~F.col("prev_hash").eqNullSafe(F.coalesce("last_hash", F.lit(GENESIS))), F.lit("LINK")),
        F.when(F.col("seq") != F.coalesce("last_seq", F.lit(0)) + 1, F.lit("SEQUENCE")),
        F.when(F.col("times") > 1, F.lit("DUPLICATE_ID")),
    )
    return seen.select("shard", "seq", F.explode(F.filter(problems, lambda p: p.isNotNull())).alias("problem"))


#: Records of a segment, whose root proves it without the rest of the chain.
SEGMENT = 1024


def _segments(chain: DataFrame, size: int) -> DataFrame:
    """One row for each segment of a shard: its ends and its root, a hash over the records' hashes in order."""
    records = F.array_sort(F.collect_list(F.struct("seq", "prev_hash", "hash", chain_hash("seq", "prev_hash", "payload").alias("own"))))
    rows = chain.withColumn("segment", F.floor((F.col("seq") - 1) / size).cast("long")).groupBy("shard", "segment").agg(records.alias("r"), F.count("*").alias("records"))
    linked = F.forall(F.zip_with(F.slice("r", 2, F.size("r")), F.slice("r", 1, F.size("r") - 1), lambda x, y: (x["prev_hash"] == y["hash"]) & (x["seq"] == y["seq"] + 1)), lambda ok: F.coalesce(ok, F.lit(False)))
    holds = F.forall("r", lambda x: x["own"].eqNullSafe(x["hash"])) & F.when(F.size("r") > 1, linked).otherwise(F.lit(True))
    return rows.select(
        "shard", "segment", "records", F.element_at("r", 1)["seq"].alias("first_seq"), F.element_at("r", 1)["prev_hash"].alias("opens_on"), F.element_at("r", -1)["hash"].alias("closes_with"),
        F.sha2(F.array_join(F.transform("r", lambda x: x["hash"]), ""), 256).alias("root"), holds.alias("holds"),
    )


def segment_roots(chain: DataFrame, size: int = SEGMENT) -> DataFrame:
    """shard, segment, records, first_seq, opens_on, closes_with, root: what has to be kept to prove a range of the chain alone."""
    return _segments(chain, size).drop("holds")


def verify_segments(part: DataFrame, roots: DataFrame, size: int = SEGMENT) -> DataFrame:
    """shard, segment, passed for each kept root: of the records at hand alone, without those before.

    A segment passes if its hashes and links hold, and if its ends and its root are those that were kept.
    """
    same = lambda c: F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    found, kept = _segments(part, size).alias("b"), roots.alias("a")
    both = kept.join(found, same("shard") & same("segment"), "left")
    ok = F.coalesce(F.col("b.holds"), F.lit(False))
    for c in ("records", "first_seq", "opens_on", "closes_with", "root"):
        ok = ok & same(c)
    return both.select("a.shard", "a.segment", ok.alias("passed"))


def verify_roots(roots: DataFrame) -> DataFrame:
    """shard, segment of every root that does not open on the close of the segment before it."""
    w = Window.partitionBy("shard").orderBy("segment")  # one row for each SEGMENT records
    before = roots.withColumn("closed", F.lag("closes_with").over(w)).withColumn("last", F.lag("segment").over(w))
    wrong = ~F.col("opens_on").eqNullSafe(F.coalesce("closed", F.lit(GENESIS))) | (F.col("segment") != F.coalesce("last", F.lit(-1)) + 1)
    return before.where(wrong).select("shard", "segment")


def cross_check(table: DataFrame, chained: DataFrame) -> DataFrame:
    """request_id and difference between the audit table and its chained copy: a missing side or a field."""
    a, b = table.alias("a"), chained.alias("b")
    both = a.join(b, F.col("a.request_id") == F.col("b.request_id"), "full_outer")
    fields = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in FIELDS if c != "request_id"]
    diff = F.when(F.col("a.request_id").isNull(), F.array(F.lit("MISSING_IN_TABLE"))).when(F.col("b.request_id").isNull(), F.array(F.lit("MISSING_IN_CHAIN"))).otherwise(F.filter(F.array(*fields), lambda f: f.isNotNull()))
    return both.select(F.coalesce("a.request_id", "b.request_id").alias("request_id"), F.explode(diff).alias("difference"))


def chained_records(chain: DataFrame) -> DataFrame:
    types = {"requested_at": "double", "completed_at": "double"}
    return chain.select(F.from_json("payload", ", ".join(f"{c} {types.get(c, 'string')}" for c in FIELDS)).alias("r")).select("r.*")


def run_log_row(spark, task: str, inputs: list[str], outputs: list[str], started: float, ended: float, status: str, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(task, inputs, outputs, started, ended, status, json.dumps(counts, sort_keys=True))], "task string, inputs array<string>, outputs array<string>, started_at double, ended_at double, status string, counts string")


def merge_run_logs(*rows: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)
