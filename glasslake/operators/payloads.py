"""Which customers a payload names: payloads that could not be read are searched as text.

A payload names a customer if it holds the id as a whole token: no letter, digit or underscore stands right before or behind
it. Quotes, commas and the payload's end make no difference, so broken JSON is searched like any other text.

Searching is one pass for all ids: payloads are cut into tokens, and a token that begins an id is a candidate (an
equality join, with the ids broadcast if they are few). The whole id is then looked for in the candidate's payload. Ids with
letters outside ASCII are looked for in their JSON escaped form as well. An id without letters or digits is no token: it is
found by the column customer_id alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasslake.operators.suppression import sized

#: A maximal run of letters, digits and underscores.
TOKEN = r"[\p{L}\p{M}\p{N}_]+"
_EDGE = r"[\p{L}\p{M}\p{N}_]"


def escaped(c: Column) -> Column:
    """A value with characters outside ASCII as JSON escapes, surrogate pairs for those beyond the basic plane."""
    four = lambda n: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))
    code = lambda ch: F.ascii(ch).cast("long")
    pair = lambda n: F.concat(four(F.lit(0xD800) + F.shiftright(n - 0x10000, 10)), four(F.lit(0xDC00) + (n - 0x10000) % 1024))
    one = lambda ch: F.when(code(ch) < 128, ch).when(code(ch) < 0x10000, four(code(ch))).otherwise(pair(code(ch)))
    return F.array_join(F.transform(F.split(c, ""), one), "")


def _forms(ids: DataFrame) -> DataFrame:
    """customer_id, form (as it may stand in a payload) and the form's first token."""
    known = ids.where("customer_id is not null").select("customer_id").distinct()
    forms = known.select("customer_id", F.explode(F.array_distinct(F.array("customer_id", escaped(F.col("customer_id"))))).alias("form"))
    return forms.withColumn("token", F.regexp_extract("form", f"({TOKEN})", 1)).where("token <> ''")


def named_customers(parked: DataFrame, ids: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """payload, customer_id of every distinct payload that names one of the customers."""
    texts = parked.where(F.col(payload).isNotNull()).select(F.col(payload).alias("payload")).distinct()
    tokens = texts.select("payload", F.explode(F.array_distinct(F.regexp_extract_all("payload", F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
    found = tokens.join(sized(_forms(ids)), "token")
    whole = F.concat(F.lit(f"(?<!{_EDGE})\\Q"), F.replace("form", F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit(f"\\E(?!{_EDGE})"))
    return found.where((F.col("token") == F.col("form")) | F.regexp_like("payload", whole)).select(F.col("payload").alias(payload), "customer_id").distinct()


def rows_of(parked: DataFrame, ids: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """parked rows of the customers, once for each customer: by the column customer_id, or named in the payload.
    The customer is in the column `named`."""
    by_text = parked.join(named_customers(parked, ids, payload).withColumnRenamed("customer_id", "named"), payload)
    if "customer_id" not in parked.columns:
        return by_text.select(*parked.columns, "named")
    known = ids.where("customer_id is not null").select("customer_id").distinct()
    by_id = parked.join(known, "customer_id", "left_semi").withColumn("named", F.col("customer_id"))
    others = by_text.where(~F.col("customer_id").eqNullSafe(F.col("named")))
    return by_id.select(*parked.columns, "named").unionByName(others.select(*parked.columns, "named"))


def without_customers(parked: DataFrame, ids: DataFrame, payload: str = "raw_payload") -> DataFrame:
    """parked without the rows of the customers."""
    kept = parked
    if "customer_id" in parked.columns:
        known = ids.where("customer_id is not null").select("customer_id").distinct()
        kept = kept.join(known, "customer_id", "left_anti")
    return kept.join(named_customers(parked, ids, payload).select(payload).distinct(), payload, "left_anti").select(*parked.columns)
