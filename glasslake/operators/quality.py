"""Data-quality checks: each is a DataFrame of (check_name, passed, detail) rows; a run records all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glasslake.functions.scalars import differs


def _row(df: DataFrame, name: str, passed, detail) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"), detail.alias("detail"))


def _text(*parts):
    return F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])


def uniqueness(df: DataFrame, key: str, name: str, allow_empty: bool = True) -> DataFrame:
    groups = df.groupBy(key).agg(F.count("*").alias("n"))
    seen = groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("twice"), F.count_if(F.col(key).isNull()).alias("nulls"))
    ok = (F.col("twice") == 0) if allow_empty else (F.col("twice") == 0) & (F.col("nulls") == 0) & (F.col("rows") > 0)
    return _row(seen, f"unique:{name}.{key}", ok, _text(F.col("twice"), " duplicate keys"))


def pii_not_clear(df: DataFrame, columns: list[str], name: str, null_ok: bool = True) -> DataFrame:
    """Every value is a 64-digit hex hash without @; all columns in one pass over all rows."""
    clear = [F.count_if(F.coalesce(~F.col(c).rlike("^[0-9a-f]{64}$") | F.col(c).contains("@"), F.lit(not null_ok))).alias(f"clear{i}") for i, c in enumerate(columns)]
    seen = df.agg(F.count("*").alias("n"), *clear)
    return reduce(DataFrame.unionByName, [_row(seen, f"pii_not_clear:{name}.{c}", F.col(f"clear{i}") == 0, _text(F.col(f"clear{i}"), " of ", F.col("n"))) for i, c in enumerate(columns)])


def consent_mirror(df: DataFrame, name: str, a: str = "marketing_consent", b: str = "consents_marketing") -> DataFrame:
    wrong = df.agg(F.count_if(differs(a, b) | F.col(a).isNull() | F.col(b).isNull()).alias("n"))
    return _row(wrong, f"consent_mirror:{name}", F.col("n") == 0, _text(F.col("n"), " rows differ"))


def referential(facts: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    lost = facts.join(dimension.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("n"))
    return _row(lost, f"referential:{name}.{key}", F.col("n") == 0, _text(F.col("n"), " orphans"))


def suppression_enforced(tables: dict[str, DataFrame], registry: DataFrame) -> DataFrame:
    ids = registry.select("customer_id").distinct()
    parts = [_row(df.join(ids, "customer_id", "left_semi").agg(F.count("*").alias("n")), f"suppression:{name}", F.col("n") == 0, _text(F.col("n"), " suppressed rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def freshness(tables: dict[str, tuple[DataFrame, str]], now: float, limit_s: float = 3600.0) -> DataFrame:
    """Age of the newest row; an empty table passes. `now` is a parameter."""
    parts = [_row(df.agg(F.max(c).alias("newest")), f"freshness:{name}", F.col("newest").isNull() | (now - F.col("newest") <= limit_s), F.coalesce(_text(F.floor(now - F.col("newest")), " s old"), F.lit("empty"))) for name, (df, c) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def volume(counts: DataFrame, history: DataFrame, drop_pct: float = 50.0) -> DataFrame:
    """counts(table_name, row_count) against the last recorded count; no history is a baseline, zero before passes."""
    w = Window.partitionBy("table_name").orderBy(F.desc("checked_at"))
    last = history.withColumn("r", F.row_number().over(w)).where("r = 1").select("table_name", F.col("row_count").alias("before"))
    lost = (F.col("before") - F.col("row_count")) * 100.0 / F.col("before")
    ok = F.when(F.col("before").isNull() | (F.col("before") == 0), True).when(F.col("row_count") == 0, False).otherwise(lost <= drop_pct)
    both = counts.join(last, "table_name", "left")
    return both.select(F.concat(F.lit("volume:"), F.col("table_name")).alias("check_name"), ok.alias("passed"), F.concat_ws(" -> ", F.coalesce(F.col("before").cast("string"), F.lit("baseline")), F.col("row_count").cast("string")).alias("detail"))


def k_anonymity(df: DataFrame, groups: list[str], name: str, k: int = 1) -> DataFrame:
    least = df.groupBy(*groups).agg(F.count_distinct("customer_id").alias("n")).agg(F.min("n").alias("least"), F.count("*").alias("groups"))
    return _row(least, f"k_anonymity:{name}", F.col("least").isNull() | (F.col("least") >= k), _text("least ", F.coalesce("least", F.lit(0)), " in ", F.col("groups"), " groups"))


def expect(df: DataFrame, rules: dict[str, str], name: str) -> DataFrame:
    """Declared row rules, as SQL conditions: violations of all rules in one pass; a NULL condition is a violation."""
    seen = df.agg(F.count("*").alias("n"), *[F.count_if(~F.coalesce(F.expr(sql), F.lit(False))).alias(f"r{i}") for i, sql in enumerate(rules.values())])
    return reduce(DataFrame.unionByName, [_row(seen, f"expect:{name}.{rule}", F.col(f"r{i}") == 0, _text(F.col(f"r{i}"), " of ", F.col("n"))) for i, rule in enumerate(rules)])


class QualityGateError(Exception):
    """Raised after all results are recorded when a check failed."""


def run_checks(spark, checks: dict, run_id: str, now: float) -> DataFrame:
    """All results of a run. A check that raises is a failed check; checks maps a name to a function of no arguments."""
    parts = []
    for name, check in checks.items():
        try:
            parts.append(spark.createDataFrame(check().collect(), "check_name string, passed boolean, detail string"))  # a few rows per check
        except Exception as e:  # a broken check must not hide the others
            parts.append(spark.createDataFrame([(name, False, f"{type(e).__name__}: {e}"[:500])], "check_name string, passed boolean, detail string"))
    found = reduce(DataFrame.unionByName, parts)
    return found.select(F.lit(run_id).alias("run_id"), "check_name", "passed", "detail", F.lit(now).alias("checked_at"))


def gate(results: DataFrame) -> None:
    failed = [r.check_name for r in results.where(~F.col("passed")).select("check_name").collect()]
    if failed:
        raise QualityGateError(", ".join(sorted(failed)))
