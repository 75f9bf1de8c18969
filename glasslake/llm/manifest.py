"""A Merkle manifest of a data set, by nested-interval labels.

Each row is a leaf. Leaves of one group (lang) are ranked by id; a node carries the interval [low, high) of the leaf
ranks that it covers, so that

- the nodes that contain a leaf are its ancestors. Nodes of level k lie in buckets of FAN_OUT ** k ranks, one node a
  bucket, so a containment join is an equality join on (group, bucket) with the interval test as its condition;
- the nodes inside a parent's interval, less the node's own interval, are its siblings.

Upwards, a level groups the one below by bucket. Downwards, a level takes its parent's path (the digests left and right
of it, level by level) and adds its own siblings. Paths are attached to runs of FAN_OUT leaves, not to leaves, until
the last join. The groups' roots are the leaves of one more such tree.

A leaf's rank comes from a range partitioning by (group, id), the place inside the partition, and the number of
leaves of the group in the partitions before: no window over a whole group, so one group may hold all rows.

Defined results: nulls count as `-` and are first; rows of one id stand in the order of their leaves, so equal rows give
equal results; a group with one leaf has it as its root; an empty table gives no rows; columns that the leaf does not
name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glasslake.llm.common import discard, materialize

FAN_OUT = 8
#: Columns of a leaf, in the order in which they are hashed.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """`-` if null, else the number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def lower_ascii(c: Column) -> Column:
    """The value with small letters for A-Z alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows with `low`, the rank inside their group, and `n`, the group's rows. Equal rows are dealt out by their place in the input."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("__deal", F.monotonically_increasing_id() % 1024)
    keys = [F.col(c) for c in (group, *order, "__deal")]
    placed = dealt.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__deal")
    placed = materialize(placed.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), name)
    # one row for each group of each partition
    sizes = placed.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    whole = Window.partitionBy(group)
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(group, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    out = placed.join(offsets, [group, "part"]).withColumn("low", F.col("place") + F.col("shift")).drop("part", "place", "shift")
    out = materialize(out, name)
    discard(placed)
    return out


def bucket(level: int) -> Column:
    return F.floor(F.col("low") / F.lit(FAN_OUT**level)).cast("long")


def covered(level: int) -> Column:
    """Whether this is the lowest level on which one node covers the whole group."""
    return (F.col("n") <= FAN_OUT**level) & ((F.col("n") > FAN_OUT ** (level - 1)) if level else F.lit(True))


def tree(leaves: DataFrame, group: str, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels from the first above the leaves, roots(group, root)) of leaves(group, n, low, digest).

    A node has group, n (the leaves of its group), low, high, digest and its children (low, high, digest) in order.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    below = leaves.withColumn("high", F.col("low") + 1)
    roots = below.where(covered(0)).select(group, F.col("digest").alias("root"))
    while most > FAN_OUT ** len(levels):
        k = len(levels) + 1
        children = F.array_sort(F.collect_list(F.struct("low", "high", "digest")))
        open_nodes = below.where(F.col("n") > FAN_OUT ** (k - 1)).withColumn("bucket", bucket(k))
        grouped = open_nodes.groupBy(group, "n", "bucket").agg(children.alias("children"))
        node = grouped.select(
            group, "n", F.element_at("children", 1)["low"].alias("low"), F.element_at("children", -1)["high"].alias("high"),
            F.sha2(F.array_join(F.col("children.digest"), ""), 256).alias("digest"), "children",
        )
        levels.append(materialize(node, f"{name}-{k}"))
        below = levels[-1].select(group, "n", "low", "high", "digest")
        roots = roots.unionByName(below.where(covered(k)).select(group, F.col("digest").alias("root")))
    return levels, roots


def attach(nodes: DataFrame, parents: DataFrame, group: str, level: int, carried: list[str]) -> DataFrame:
    """nodes below `level` with what their parents carry, and with their siblings in front of the parents' path.

    parents: group, low, high, children, path (array of (left, right) digests from here to the top) and the carried columns.
    """
    kids = parents.select(F.col(group).alias("__group"), F.col("low").alias("__low"), F.col("high").alias("__high"), "children", F.col("path").alias("__path"), *carried, bucket(level).alias("__bucket"))
    inside = (F.col(group) == F.col("__group")) & (bucket(level) == F.col("__bucket")) & (F.col("low") >= F.col("__low")) & (F.col("high") <= F.col("__high"))
    joined = nodes.join(kids, inside)
    side = lambda test: F.array_join(F.transform(F.filter("children", test), lambda c: c["digest"]), "")
    step = F.struct(side(lambda c: c["high"] <= F.col("low")).alias("left"), side(lambda c: c["low"] >= F.col("high")).alias("right"))
    return joined.withColumn("path", F.concat(F.array(step), F.col("__path"))).drop("__group", "__low", "__high", "__bucket", "__path", "children")


def with_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, group: str, name: str) -> DataFrame:
    """leaves with their path to the top, and the columns of tops(group, path, further columns): one row a group.

    A group's own path is where its root's siblings begin: it joins on the level where one node covers the group.
    """
    carried = [c for c in tops.columns if c not in (group, "path")]
    above: DataFrame | None = None
    for k in range(len(levels), 0, -1):
        nodes = levels[k - 1].select(group, "n", "low", "high", F.col("children").alias("own"))
        start = nodes.where(covered(k)).join(tops, group)
        if above is not None:
            start = start.unionByName(attach(nodes.where(F.col("n") > FAN_OUT**k), above, group, k + 1, carried))
        above = materialize(start.withColumnRenamed("own", "children"), f"{name}-path-{k}")
    out = leaves.withColumn("high", F.col("low") + 1)
    single = out.where(covered(0)).join(tops, group)
    return single if above is None else single.unionByName(attach(out.where("n > 1"), above, group, 1, carried))


def fold(leaf: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    return F.aggregate("path", leaf, lambda at, step: digest(step["left"], at, step["right"]))


def manifest(docs: DataFrame, group: str = "lang", columns: tuple[str, ...] = LEAF, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path (array of the siblings' digests, left and right of each ancestor, upwards) and
    tampered_leaf: the leaf with `tampered` in place of the text."""
    values = {c: F.col(c) for c in columns}
    leaf = digest(*[field(v) for v in values.values()])
    other = digest(*[field(tampered if c == "text" and tampered is not None else v) for c, v in values.items()])
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null first, then by bytes
    base = docs.select("doc_id", leaf.alias("digest"), other.alias("tampered_leaf"), key.alias("__key"))
    leaves = ranked(base, "__key", ["doc_id", "digest"], "manifest-leaves")
    levels, roots = tree(leaves.select("__key", "n", "low", "digest"), "__key", "manifest")
    groups = ranked(roots.select(F.lit("").alias("all"), "__key", F.col("root").alias("digest")), "all", ["__key"], "manifest-groups")
    upper, top = tree(groups.select("all", "n", "low", "digest"), "all", "manifest-top")
    top = top.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    tops = with_paths(groups, upper, top, "all", "manifest-top").select("__key", "path", F.col("digest").alias("subroot"), "root")
    tops = materialize(tops, "manifest-tops")
    out = materialize(with_paths(leaves, levels, tops, "__key", "manifest"), "manifest-paths")
    discard(leaves, *levels, groups, *upper, tops)
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", "tampered_leaf")


def proofs(entries: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of manifest(): a leaf is verified if its tampered
    form still gives the root."""
    steps = F.concat(F.array(F.lit("")), F.transform("path", lambda s: F.concat(s["left"], s["right"])))
    folded = entries.withColumn("folded_root", fold(F.col("tampered_leaf")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join(steps, ""), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
