"""The SQL surface: stored tables as views, SQL functions as masks and row filters, and statements with bound parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from glasslake.operators.contracts import check_identifier
from glasslake.operators.privacy import masked_view
from glasslake.sources.lake import Lake

#: Fixed value: what stands in place of a value that the session's roles may not see.
MASKED = "<masked>"


@dataclass
class Policy:
    """Masks (column -> SQL function) and a row filter (SQL function over columns) of one table.

    Functions are those of define_functions, or any other SQL function of the session that takes these columns.
    """

    masks: dict[str, str] = field(default_factory=dict)
    row_filter: tuple[str, tuple[str, ...]] | None = None


def define_functions(spark: SparkSession, roles: set[str] | frozenset[str] = frozenset()) -> list[str]:
    """The session's SQL functions for policies; what they show depends on the roles of whoever queries.

    has_role(role); mask_pii(value): the value for pii_reader alone; mask_email(value): the domain stays; unrestricted(flag):
    rows that are marked are for pii_reader alone. They are plain SQL expressions, so Catalyst takes them apart like any other:
    a filter on a masked column works on the masked value.
    """
    listed = ", ".join(f"'{check_identifier(r)}'" for r in sorted(roles)) or "NULL"
    functions = {
        "has_role(role STRING) RETURNS BOOLEAN": f"coalesce(role IN ({listed}), FALSE)",
        "mask_pii(value STRING) RETURNS STRING": f"CASE WHEN has_role('pii_reader') THEN value WHEN value IS NOT NULL THEN '{MASKED}' END",
        "mask_email(value STRING) RETURNS STRING": f"CASE WHEN has_role('pii_reader') THEN value WHEN value LIKE '%@%' THEN concat('{MASKED}@', substring_index(value, '@', -1)) WHEN value IS NOT NULL THEN '{MASKED}' END",
        "unrestricted(restricted BOOLEAN) RETURNS BOOLEAN": "has_role('pii_reader') OR NOT coalesce(restricted, TRUE)",
    }
    for head, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in functions]


def policy_view(spark: SparkSession, name: str, df: DataFrame, policy: Policy) -> str:
    """A temporary view layer_table of df under a policy: masks are applied behind the row filter, which sees the values."""
    view = check_identifier(name).replace(".", "_")
    columns = [f"{check_identifier(policy.masks[c])}(`{c}`) AS `{c}`" if c in policy.masks else f"`{c}`" for c in df.columns]
    if missing := set(policy.masks) - set(df.columns):
        raise ValueError(f"{name} has no columns {sorted(missing)}")  # fail closed: a mask that binds nothing hides nothing
    where = ""
    if policy.row_filter is not None:
        function, over = policy.row_filter
        where = f" WHERE {check_identifier(function)}({', '.join(f'`{check_identifier(c)}`' for c in over)})"
    spark.sql(f"SELECT {', '.join(columns)} FROM {{df}}{where}", df=df).createOrReplaceTempView(view)
    return view


def register_views(lake: Lake, names: list[str], masks: dict[str, list[str]] | None = None, allowed: bool = False, policies: dict[str, Policy] | None = None) -> list[str]:
    """A temporary view layer_table per stored table; personal columns are masked unless allowed, or by the table's policy."""
    made = []
    for name in names:
        df = lake.read(name)
        if policies and name in policies:
            made.append(policy_view(lake.spark, name, df, policies[name]))
            continue
        view = check_identifier(name).replace(".", "_")
        if masks and name in masks:
            df = masked_view(df, masks[name], allowed)
        df.createOrReplaceTempView(view)
        made.append(view)
    return made


def run_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """A statement with :name parameters; values are bound and never become part of the text."""
    return spark.sql(text, args=args or {})
