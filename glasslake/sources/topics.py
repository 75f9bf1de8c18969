"""Reading events from topics and partner files, and splitting them into valid rows and quarantine."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasslake.operators.contracts import CORRUPT, EVENTS, contract_status, event_schema, normalise, parse, parse_kinds, project_event, quarantine_projection, reason_of, recover_ids, with_lineage, with_status
from glasslake.operators.audit import run_log_row
from glasslake.operators.incremental import get_watermark
from glasslake.operators.suppression import not_suppressed
from glasslake.sources.lake import Lake, first_per_key

RECORD = T.StructType([T.StructField(n, t) for n, t in (("topic", T.StringType()), ("key", T.StringType()), ("value", T.StringType()), ("partition", T.IntegerType()), ("offset", T.LongType()), ("timestamp", T.TimestampType()))])


def _records(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("_kafka_ts"), F.col("partition").alias("_kafka_partition"), F.col("offset").alias("_kafka_offset"))


#: Kafka's names for the ends of a topic.
EARLIEST, LATEST = "earliest", "latest"
Offsets = str | dict[int, int]


def _kafka_offsets(topic: str, at: Offsets) -> str:
    return at if isinstance(at, str) else json.dumps({topic: {str(p): n for p, n in at.items()}})


def read_topic(spark: SparkSession, topic: str, event_type: str, servers: str | None = None, path: str | None = None, stream: bool = True, starting: Offsets = EARLIEST, ending: Offsets = LATEST) -> DataFrame:
    """Parsed records of a topic: from Kafka, or from a folder of JSON records with the same columns.

    starting is where a stream without a checkpoint begins, and a batch too; ending is where a batch stops (it is not read).
    Both are earliest, latest or an offset for each partition; -2 and -1 are a partition's earliest and latest. A folder
    reads partitions that an offset dict leaves out as a whole, and has no latest to start from.
    """
    reader = spark.readStream if stream else spark.read
    if servers is not None:
        reader = reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", _kafka_offsets(topic, starting)).option("failOnDataLoss", "false")
        return parse(_records((reader if stream else reader.option("endingOffsets", _kafka_offsets(topic, ending))).load()), event_type)
    if starting == LATEST:
        raise ValueError("a folder of records has no latest offset to start from")
    raw = reader.schema(RECORD).json(path).where(F.col("topic") == topic)
    for at, bound in ((starting, F.col("offset").__ge__), (ending, F.col("offset").__lt__)):
        if not isinstance(at, str):
            inside = F.lit(True)
            for p, n in at.items():
                if n >= 0:
                    inside = inside & ((F.col("partition") != p) | bound(F.lit(n)))
            raw = raw.where(inside)
    return parse(_records(raw), event_type)


#: What a partner row holds beside its contract: unknown fields, and values of other types.
RESCUED = "_rescued_data"


def rescue(lines: DataFrame, event_type: str) -> DataFrame:
    """Rows of the contract from lines(value, ...), and what does not fit it as JSON in _rescued_data.

    A line is parsed once, as VARIANT. A field of the contract's type is taken; a value of another type leaves the field NULL
    and is rescued with its name, as is every field that the contract does not know. Numbers fit numbers if nothing is
    lost. A line that is no JSON object is corrupt, and its text is the payload; a readable one is its own payload.
    """
    schema = event_schema(event_type)
    fields = [f for f in schema.fields if f.name != CORRUPT]
    parsed = lines.withColumn("__v", F.try_parse_json("value"))
    whole = F.schema_of_variant("__v").startswith("OBJECT")
    parsed = parsed.withColumn("__v", F.when(whole, F.col("__v")))
    kept = {}
    for f in fields:
        raw, typed = F.try_variant_get("__v", f"$.{f.name}", "variant"), F.try_variant_get("__v", f"$.{f.name}", f.dataType.simpleString())
        kind = F.schema_of_variant(raw)
        # a number is no text and a text no number, though each could be cast
        fits = kind == "STRING" if isinstance(f.dataType, T.StringType) else kind == "BOOLEAN" if isinstance(f.dataType, T.BooleanType) else ~kind.isin("STRING", "BOOLEAN") & (typed.cast("double") == F.try_variant_get("__v", f"$.{f.name}", "double")) & (F.abs(typed) < float("inf"))
        kept[f.name] = F.when(F.coalesce(fits, F.lit(False)), typed)
    typed = parsed.select("*", F.struct(*[c.alias(n) for n, c in kept.items()]).alias("__typed"))
    names = F.array(*[F.lit(f.name) for f in fields])
    held = F.from_json(F.to_json("__v"), "map<string,string>")
    missed = F.array(*[F.when(F.col(f"__typed.{f.name}").isNull(), F.lit(f.name)) for f in fields])
    odd = F.map_filter(held, lambda k, v: v.isNotNull() & (~F.array_contains(names, k) | F.array_contains(F.filter(missed, lambda x: x.isNotNull()), k)))
    rest = [c for c in lines.columns if c != "value"]
    return typed.select(
        *[f"__typed.{f.name}" for f in fields], F.when(F.col("__v").isNull(), F.col("value")).alias(CORRUPT), *rest,
        F.when(F.size(odd) > 0, F.to_json(odd)).alias(RESCUED), F.coalesce(F.to_json("__v"), F.col("value")).alias("raw_payload"),
    )


def read_partner_files(spark: SparkSession, path: str, event_type: str, stream: bool = True, strict: bool = True) -> DataFrame:
    """JSON drops of partners with file lineage, and fields beyond the contract as rescued data.

    strict: a row with rescued data counts as corrupt and is quarantined with its whole text.
    """
    reader = spark.readStream if stream else spark.read
    lines = reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.file_modification_time").alias("_file_modification_time"))
    rows = rescue(lines.where(F.trim("value") != ""), event_type)
    return rows.withColumn(CORRUPT, F.coalesce(CORRUPT, RESCUED)) if strict else rows


def flagged(parsed: DataFrame, event_type: str, source: str) -> DataFrame:
    """Parsed records with recovered ids, lineage and contract status."""
    return contract_status(with_lineage(recover_ids(normalise(parsed)), source), event_type)


def ingest(parsed: DataFrame, event_type: str, source: str, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): every record of an unsuppressed customer is in exactly one of them."""
    rows = not_suppressed(flagged(parsed, event_type, source), registry)
    return project_event(rows.where(~F.col("_is_malformed")), event_type), quarantine_projection(rows.where("_is_malformed"))


#: Seconds that an event may come behind the newest one of its stream.
LATENESS_S = 30 * 86_400.0


#: Marks of a stream after which older ones become one.
COMPACT_MARKS = 64


def _mark_before(lake: Lake, pipeline: str, name: str) -> float:
    """The newest event time of the stream's earlier batches; what a first try of this batch has left does not count."""
    if not lake.exists("governance.watermarks"):
        return 0.0
    return get_watermark(lake.stored("governance.watermarks").where(F.col("_batch") < name), pipeline)


def ingest_stream(parsed: DataFrame, event_type: str, source: str, registry, lake: Lake, table: str, checkpoint: str, available_now: bool = True, lateness_s: float = LATENESS_S):
    """Stream ingest: the registry is read again in every micro-batch, so that an erasure takes effect at once.

    Events that come more than lateness_s behind the newest event of earlier batches go to bronze.late_events. A
    micro-batch writes partitions of its own name in every table, its mark and its counts included, and looks at earlier
    batches alone: one that is repeated after a crash gives what it gave before. Its rows are counted in the pass that
    reads them.
    """
    pipeline = f"stream:{table}"

    def batch(df: DataFrame, number: int) -> None:
        name = f"{table}-{number:012d}"
        began, read, split = time.time(), Observation(), Observation()
        seen = _mark_before(lake, pipeline, name)
        rows = flagged(df, event_type, source).observe(read, F.count("*").alias("read"))
        late = F.coalesce(F.col("occurred_at") < seen - lateness_s, F.lit(False)) & ~F.col("_is_malformed")
        rows = not_suppressed(rows, registry()).withColumn("__late", late)
        counts = [F.count_if("_is_malformed").alias("malformed"), F.count_if("__late").alias("late"), F.count("*").alias("kept"), F.max(F.when(~F.col("_is_malformed"), F.col("occurred_at"))).alias("newest")]
        rows = rows.observe(split, *counts).persist()
        valid = project_event(rows.where("NOT _is_malformed AND NOT __late"), event_type)
        lake.insert_ignore(table, valid, "event_id", [F.col("_kafka_offset").asc_nulls_last(), F.col("occurred_at")], name)
        found = {**read.get, **split.get}
        if found["late"]:
            behind = project_event(rows.where("__late"), event_type)
            behind = behind.select("event_id", F.lit(table).alias("table_name"), "customer_id", "occurred_at", F.to_json(F.struct(*behind.columns)).alias("event"))
            lake.insert_ignore("bronze.late_events", behind, "event_id", [F.col("occurred_at")], name)
        lake.insert_ignore("bronze.ingest_quarantine", quarantine_projection(rows.where("_is_malformed")), "quarantine_id", [F.col("source_offset").asc_nulls_last()], name)
        newest = max(seen, found["newest"] or 0.0)
        lake.append("governance.watermarks", df.sparkSession.createDataFrame([(pipeline, newest)], "pipeline string, last_ts double"), name)
        numbers = {k: found[k] for k in ("read", "malformed", "late")} | {"suppressed": found["read"] - found["kept"]}
        lake.append("governance.run_log", run_log_row(df.sparkSession, pipeline, [source], [table, "bronze.late_events", "bronze.ingest_quarantine"], began, time.time(), "completed", numbers), name)
        rows.unpersist()
        own = [b for b in lake.batches("governance.watermarks") if b.startswith(f"{table}-")]
        if len(own) > COMPACT_MARKS:
            lake.compact("governance.watermarks", own[:-2])

    w = parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def load_bronze(spark: SparkSession, records: DataFrame, registry: DataFrame) -> dict[str, DataFrame]:
    """A batch of topic records to one table per event type, first row per event_id, and the quarantine of all.

    A table reads the log once: records of all types are parsed, flagged and freed of suppressed customers in one pass.
    """
    kind = F.get_json_object(F.col("value").cast("string"), "$.event_type")
    parsed = parse_kinds(_records(records).withColumn("_kind", kind), "_kind", "page_click")
    reason = F.when(~F.coalesce(F.col("_kind").isin(*EVENTS), F.lit(False)), F.coalesce(reason_of("page_click", False), F.lit("EVENT_TYPE_MISMATCH")))
    for event_type, contract in EVENTS.items():
        reason = reason.when(F.col("_kind") == event_type, reason_of(event_type, "amount_eur" in dict(contract["fields"])))
    rows = not_suppressed(with_status(with_lineage(recover_ids(normalise(parsed)), "log"), reason), registry)
    out = {}
    for event_type in EVENTS:
        valid = project_event(rows.where((F.col("_kind") == event_type) & ~F.col("_is_malformed")), event_type)
        out[event_type] = first_per_key(valid, "event_id", [F.col(c).asc_nulls_last() for c in ("_kafka_partition", "_kafka_offset", "occurred_at")])
    out["quarantine"] = quarantine_projection(rows.where("_is_malformed"))
    return out


def replay(spark: SparkSession, records: DataFrame, registry: DataFrame, limit: int | None = None) -> tuple[dict[str, DataFrame], list[str]]:
    """Bronze from the whole log, and warnings; running it twice gives the same tables."""
    if limit is not None:
        records = records.orderBy("topic", "partition", "offset").limit(limit)
    warnings = ["the suppression registry is empty"] if registry.isEmpty() else []
    return load_bronze(spark, records, registry), warnings


def dead_letters(requests: DataFrame, cursor: DataFrame) -> DataFrame:
    """Parked requests from the handled cursor (topic, next_offset) on."""
    return requests.join(cursor, "topic", "left").where(F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")


def acknowledge(cursor: DataFrame, handled: DataFrame) -> DataFrame:
    """The cursor moved behind the handled rows."""
    moved = handled.groupBy("topic").agg((F.max("offset") + 1).alias("next_offset"))
    return cursor.unionByName(moved).groupBy("topic").agg(F.max("next_offset").alias("next_offset"))


def requeue(intake: DataFrame, dead: DataFrame, cursor: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(intake with the dead letters again, cursor behind them)."""
    return intake.unionByName(dead.select(*intake.columns)), acknowledge(cursor, dead)
