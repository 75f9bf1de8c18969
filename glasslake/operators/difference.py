"""Which rows of two copies of a table differ, by a hash tree over buckets of keys.

The leaves of the tree are buckets of a key's hash, with the number of their rows and a digest that does not depend on the
order of the rows; a node sums FAN_OUT nodes below it. Two trees are compared from the root down, and only below nodes
that differ. Trees are small and can be kept with each copy: then a comparison reads rows of differing buckets alone, and
from a lake's tables only their partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glasslake.sources.lake import Lake

FAN_OUT = 16
#: Levels below the root: FAN_OUT ** DEPTH leaves.
DEPTH = 3


def leaf_of(key: str, leaves: int = FAN_OUT**DEPTH) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(leaves)).cast("int")


def row_digest(columns: list[str]) -> Column:
    """128 bits of a row's content as two numbers; nulls and column names count."""
    whole = F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit("second"), whole).alias("b"))


def hash_tree(df: DataFrame, leaf: Column, columns: list[str] | None = None, depth: int = DEPTH) -> DataFrame:
    """level (0 is the root), node, rows, a, b of every node that has rows.

    Sums of digests modulo 2 ** 61 - 1 tell repeated rows apart, which an exclusive or would not.
    """
    add = lambda c: F.pmod(F.sum(F.pmod(c, F.lit(2**61 - 1)).cast("decimal(38,0)")), F.lit(2**61 - 1).cast("decimal(38,0)")).cast("long")
    rows = df.select(leaf.alias("node"), row_digest(columns or df.columns).alias("d"))
    level = rows.groupBy("node").agg(F.count("*").alias("rows"), add(F.col("d.a")).alias("a"), add(F.col("d.b")).alias("b"))
    out = level.withColumn("level", F.lit(depth))
    for k in range(depth - 1, -1, -1):
        parent = F.floor(F.col("node") / FAN_OUT ** (depth - k)).cast("int")
        out = out.unionByName(level.groupBy(parent.alias("node")).agg(F.sum("rows").alias("rows"), add(F.col("a")).alias("a"), add(F.col("b")).alias("b")).withColumn("level", F.lit(k)))
    return out.select("level", "node", "rows", "a", "b")


def differing_leaves(one: DataFrame, other: DataFrame, depth: int = DEPTH) -> list[int]:
    """Leaves of two hash_tree tables that are not alike, found from the root down; at most FAN_OUT ** depth numbers."""
    nodes = [0]
    for k in range(depth + 1):
        if not nodes:
            break
        a, b = (t.where((F.col("level") == k) & F.col("node").isin(nodes)).alias(n) for t, n in ((one, "a"), (other, "b")))
        same = (F.col("a.rows") == F.col("b.rows")) & (F.col("a.a") == F.col("b.a")) & (F.col("a.b") == F.col("b.b"))
        both = a.join(b, F.col("a.node") == F.col("b.node"), "full_outer").where(~F.coalesce(same, F.lit(False)))
        found = [r[0] for r in both.select(F.coalesce("a.node", "b.node")).collect()]  # bounded by the leaves
        nodes = sorted(found) if k == depth else sorted(FAN_OUT * n + c for n in found for c in range(FAN_OUT))
    return nodes


def differences(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """key and difference: MISSING_IN_COPY, MISSING_IN_PRIMARY, CHANGED, or COUNT where a key has more rows on one side."""
    columns = sorted(set(one.columns) & set(other.columns))
    side = lambda df: df.select(F.col(key).alias("key"), row_digest(columns).alias("d")).groupBy("key").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("d")).alias("d"))
    a, b = side(one).alias("a"), side(other).alias("b")
    both = a.join(b, F.col("a.key").eqNullSafe(F.col("b.key")), "full_outer")
    what = F.when(F.col("b.n").isNull(), "MISSING_IN_COPY").when(F.col("a.n").isNull(), "MISSING_IN_PRIMARY").when(F.col("a.n") != F.col("b.n"), "COUNT").when(F.col("a.d") != F.col("b.d"), "CHANGED")
    return both.select(F.coalesce("a.key", "b.key").alias(key), what.alias("difference")).where("difference is not null")


def reconcile_keys(one: DataFrame, other: DataFrame, key: str, depth: int = DEPTH) -> DataFrame:
    """differences() of two tables, read in the buckets that differ alone."""
    leaf, columns = leaf_of(key, FAN_OUT**depth), sorted(set(one.columns) & set(other.columns))
    leaves = differing_leaves(hash_tree(one, leaf, columns, depth), hash_tree(other, leaf, columns, depth), depth)
    return differences(one.where(leaf.isin(leaves)), other.where(leaf.isin(leaves)), key)


def reconcile_lakes(primary: Lake, copy: Lake, name: str, key: str) -> DataFrame:
    """differences() of a table in two lakes: the trees' leaves are the buckets of customers, so the rows are read from the
    partitions that differ alone."""
    if primary.buckets != copy.buckets:
        raise ValueError("the lakes have other buckets")
    depth = 1
    while FAN_OUT**depth < primary.buckets:
        depth += 1
    one, other = primary.stored(name), copy.stored(name)
    columns = [c for c in primary.read(name).columns if c in copy.read(name).columns]
    leaves = differing_leaves(hash_tree(one, F.col("_bucket"), columns, depth), hash_tree(other, F.col("_bucket"), columns, depth), depth)
    pick = lambda rows: rows.where(F.col("_bucket").isin(leaves)).select(*columns)
    return differences(pick(one), pick(other), key)
