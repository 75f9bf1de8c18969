"""Event contracts: parsing, status of each record, quarantine, and drift between contract snapshots."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _B, _I = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType()
_BASE = [("schema_version", _I), ("event_id", _S), ("event_type", _S), ("occurred_at", _D)]
#: Fields of each event, its required ones and its rules.
EVENTS: dict[str, dict] = {
    "order_placed": {"fields": [("order_id", _S), ("customer_id", _S), ("email", _S), ("iban", _S), ("country", _S), ("amount_eur", _D), ("marketing_consent", _B), ("currency", _S)], "required": ["order_id", "customer_id", "email", "iban", "country", "amount_eur", "marketing_consent"]},
    "page_click": {"fields": [("click_id", _S), ("customer_id", _S), ("session_id", _S), ("ip_address", _S), ("page", _S), ("country", _S)], "required": ["click_id", "customer_id", "session_id", "ip_address", "page", "country"]},
    "payment_processed": {"fields": [("payment_id", _S), ("order_id", _S), ("customer_id", _S), ("iban", _S), ("country", _S), ("merchant_country", _S), ("amount_eur", _D), ("status", _S)], "required": ["payment_id", "order_id", "customer_id", "iban", "country", "merchant_country", "amount_eur"]},
    "erasure_requested": {"fields": [("request_id", _S), ("customer_id", _S), ("reason", _S), ("requested_by", _S)], "required": ["request_id", "customer_id"]},
}
DEFAULTS = {"schema_version": 1, "currency": "EUR", "status": "authorized", "reason": "GDPR_ARTICLE_17"}
CORRUPT = "_corrupt_record"
LINEAGE = {"_occurred_at": "timestamp", "_ingested_at": "timestamp", "_source": "string", "_kafka_ts": "timestamp", "_kafka_partition": "int", "_kafka_offset": "bigint", "_file_path": "string", "_file_modification_time": "timestamp"}


def event_schema(event_type: str) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in [*_BASE, *EVENTS[event_type]["fields"], (CORRUPT, _S)]])


def check_identifier(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*){0,2}", name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def parse(df: DataFrame, event_type: str, value: str = "value") -> DataFrame:
    """JSON text to columns; what cannot be read stays in the corrupt-record column, the text in raw_payload."""
    parsed = F.from_json(F.col(value).cast("string"), event_schema(event_type), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return df.withColumn("raw_payload", F.col(value).cast("string")).withColumn("e", parsed).select("raw_payload", *[c for c in df.columns if c != value], "e.*")


def normalise(df: DataFrame) -> DataFrame:
    """White space off string fields and defaults for missing ones."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (CORRUPT, "raw_payload") and not f.name.startswith("_")]
    out = df.withColumns({c: F.trim(F.col(c)) for c in texts})
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items() if c in df.columns})


def recover_ids(df: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """Customer and event ids of unreadable payloads, so that suppression and keys still apply to them."""
    found = lambda c: F.nullif(F.regexp_extract(payload, rf'"{c}"\s*:\s*"([^"]+)"', 1), F.lit(""))
    return df.withColumns({c: F.coalesce(F.col(c), found(c)) for c in ("customer_id", "event_id")})


def with_lineage(df: DataFrame, source: str, now: Column | None = None) -> DataFrame:
    made = {"_source": F.lit(source), "_ingested_at": now if now is not None else F.current_timestamp(), "_occurred_at": F.timestamp_seconds("occurred_at")}
    return df.withColumns({c: made.get(c, F.lit(None)).cast(t) for c, t in LINEAGE.items() if c not in df.columns})


def reason_of(event_type: str, amount: bool) -> Column:
    """The first reason that holds against a record of the type, or NULL; every condition is null-safe."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in EVENTS[event_type]["required"]])
    broken = F.lit(False)
    if amount:
        broken = broken | ~F.coalesce((F.col("amount_eur") >= 0) & ~F.isnan("amount_eur"), F.lit(False))
    if event_type == "payment_processed":
        broken = broken | ~F.coalesce(F.col("status").isin("authorized", "declined", "captured"), F.lit(True))
    if event_type == "erasure_requested":
        broken = broken | ~F.coalesce(F.col("reason") == "GDPR_ARTICLE_17", F.lit(True))
    bad_time = ~F.coalesce((F.col("occurred_at") > 0) & ~F.isnan("occurred_at"), F.lit(False))
    return (
        F.when(F.col(CORRUPT).isNotNull(), "JSON_PARSE_ERROR")
        .when(F.col("event_id").isNull() | (F.trim("event_id") == ""), "EVENT_ID_MISSING")
        .when(~F.col("event_type").eqNullSafe(F.lit(event_type)), "EVENT_TYPE_MISMATCH")
        .when(missing, "REQUIRED_FIELD_MISSING")
        .when(broken, "BUSINESS_RULE_FAILED")
        .when(bad_time, "INVALID_OCCURRED_AT")
    )


def with_status(df: DataFrame, reason: Column) -> DataFrame:
    """quarantine_reason and _is_malformed.

    The reason comes out of a generator of one row: a filter on a plain column would be pushed below the parsing, and
    each of its many fields would parse the record again.
    """
    return df.select("*", F.explode(F.array(reason)).alias("quarantine_reason")).withColumn("_is_malformed", F.col("quarantine_reason").isNotNull())


def contract_status(df: DataFrame, event_type: str) -> DataFrame:
    """_is_malformed and the first reason that holds."""
    return with_status(df, reason_of(event_type, "amount_eur" in df.columns))


def parse_kinds(df: DataFrame, kind: str, other: str, value: str = "value") -> DataFrame:
    """JSON text to the columns of all event types, each record by the contract that its kind names, else by other's.

    A record is parsed once; fields that its own contract does not know are NULL.
    """
    text, own = F.col(value).cast("string"), F.when(F.col(kind).isin(*EVENTS), F.col(kind)).otherwise(other)
    schemas = {t: event_schema(t) for t in EVENTS}
    read = {t: F.when(own == t, F.from_json(text, s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})) for t, s in schemas.items()}
    names = list(dict.fromkeys(n for s in schemas.values() for n in s.names))
    made = [F.coalesce(*[F.col(f"__{t}.{n}") for t, s in schemas.items() if n in s.names]).alias(n) for n in names]
    return df.withColumn("raw_payload", text).withColumns({f"__{t}": c for t, c in read.items()}).select("raw_payload", *[c for c in df.columns if c != value], *made)


def project_event(df: DataFrame, event_type: str) -> DataFrame:
    fields = [n for n, _ in [*_BASE, *EVENTS[event_type]["fields"]]]
    return df.select(*fields, *[c for c in LINEAGE if c in df.columns])


def quarantine_projection(df: DataFrame) -> DataFrame:
    """Deterministic id from the event id, or from the source coordinates and the payload."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    own = F.sha2(F.concat(F.lit("event|"), F.col("event_id")), 256)
    other = F.sha2(F.concat_ws("|", F.lit("source"), *[part(c) for c in ("_source", "_kafka_partition", "_kafka_offset", "_file_path", "raw_payload")]), 256)
    status = F.when(F.col("customer_id").isNull(), "CUSTOMER_ID_UNKNOWN").otherwise("NOT_SUPPRESSED")
    return df.select(
        F.coalesce(own, other).alias("quarantine_id"), F.col("_source").alias("source_name"), F.col("_kafka_partition").alias("source_partition"), F.col("_kafka_offset").alias("source_offset"),
        F.col("_file_path").alias("file_path"), "event_id", "customer_id", "raw_payload", "quarantine_reason", status.alias("suppression_status"), F.col("_occurred_at").alias("occurred_at"), F.col("_ingested_at").alias("ingested_at"),
    )


def contract_of(schemas: dict[str, T.StructType], required: dict[str, list[str]]) -> list[tuple[str, str, str, bool]]:
    """(topic, field, type, required) rows of event schemas."""
    return [(topic, f.name, f.dataType.simpleString(), f.name in required.get(topic, [])) for topic, s in schemas.items() for f in s.fields if f.name != CORRUPT]


def infer_contract(records: DataFrame) -> DataFrame:
    """(topic, field, type, required) of records(topic, record_id, field, value): what their fields held.

    A field is required if every record of its topic has it, and a number's type is the smallest that held all values.
    """
    value = F.col("value").cast("double")
    kind = F.when(F.count_if(value.isNull()) > 0, "string").when(F.count_if(value != F.floor(value)) > 0, "double").when(F.max(F.abs(value)) > 2_147_483_647, "bigint").otherwise("int")
    fields = records.groupBy("topic", "field").agg(kind.alias("type"), F.count_distinct("record_id").alias("n"))
    sizes = records.groupBy("topic").agg(F.count_distinct("record_id").alias("size"))
    return fields.join(sizes, "topic").select("topic", "field", "type", (F.col("n") == F.col("size")).alias("required"))


def contract_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Breaking changes between snapshots (topic, field, type, required); a new topic or optional field breaks nothing."""
    b, c = baseline.alias("b"), current.alias("c")
    both = b.join(c, (F.col("b.topic") == F.col("c.topic")) & (F.col("b.field") == F.col("c.field")), "full_outer")
    topics = lambda df, name: df.select("topic").distinct().withColumn(name, F.lit(True))
    rows = both.select(F.coalesce("b.topic", "c.topic").alias("topic"), F.coalesce("b.field", "c.field").alias("field"), F.col("b.type").alias("t0"), F.col("c.type").alias("t1"), F.col("b.required").alias("r0"), F.col("c.required").alias("r1"))
    rows = rows.join(topics(baseline, "in0"), "topic", "left").join(topics(current, "in1"), "topic", "left")
    change = (
        F.when(F.col("in1").isNull(), "TOPIC_REMOVED")
        .when(F.col("in0").isNull(), None)
        .when(F.col("t1").isNull() & F.col("r0"), "REQUIRED_FIELD_REMOVED")
        .when(F.col("t0").isNull() & F.col("r1"), "REQUIRED_FIELD_ADDED")
        .when((F.col("t0") != F.col("t1")) & (F.col("r0") | F.col("r1")), "TYPE_CHANGED")
        .when(F.col("r0") & ~F.col("r1"), "REQUIRED_MADE_OPTIONAL")
        .when(~F.col("r0") & F.col("r1"), "OPTIONAL_MADE_REQUIRED")
    )
    found = rows.select("topic", F.when(F.col("in1").isNull(), F.lit("")).otherwise(F.col("field")).alias("field"), change.alias("change"))
    return found.where("change is not null").distinct()
