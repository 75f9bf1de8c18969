"""Shared helpers of the training-data operators: work tables, run-wise pair search, connected components.

Nothing here gathers rows on the driver: work tables are Parquet in the folder that all executors share, pair
search streams sorted runs, and components are found by joins.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one block of a run may hold; longer runs are split into blocks of about this size.
BLOCK_ROWS = 4096


def work_dir(spark: SparkSession) -> str:
    """The folder shared by driver and executors: spark.checkpoint.dir; a temporary one only where all run in one process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="glasslake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/work"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of work tables, and of what is read straight from them, when nothing reads them any more."""
    for df in tables:
        spark = df.sparkSession
        home, jvm = work_dir(spark), spark.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if home.split(":", 1)[-1].lstrip("/") in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Ids up to which a table of them is broadcast (16 MB); a larger one is joined by a shuffle.
BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """docs but for those whose id is in ids; rows without an id stay. Few ids are broadcast, so that texts stay put."""
    named = materialize(ids.where(F.col(column).isNotNull()).select(column).distinct(), "ids")
    few = named.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(named) if few else named, column, "left_anti").select(*docs.columns)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so that other columns and their names do not matter."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def crc_bucket(id_col: str, modulus: int):
    """crc32 of the id written as text, modulo the given number; the folds of the classifiers."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(modulus))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 18, most_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about a quarter of a megabyte of text each (one row at least): a step holds some 100 bytes per byte of text."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)) if batch.num_rows else []
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = min(at + most_rows, max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right"))))
        yield batch.slice(at, stop - at)
        at = stop


# ---------------------------------------------------------------- forests


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace links by a star per connected group: (member, smallest member), at most one row per member."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


# ---------------------------------------------------------------- pairs within runs of equal keys


def _shifted_pairs(key: np.ndarray, near: Callable | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, i + d) of rows with equal keys, for d = 1, 2, ...; near(i, j) ends a row's window when false."""
    live = np.arange(len(key) - 1)
    d = 1
    while len(live):
        live = live[live + d < len(key)]
        live = live[key[live] == key[live + d]]
        if near is not None and len(live):
            live = live[near(live, live + d)]
        if len(live):
            yield live, live + d
        d += 1


def _column(x: pa.Array) -> np.ndarray:
    """Numbers as an array, lists of one length as a matrix, other lists as an array of arrays."""
    if not pa.types.is_list(x.type):
        return x.to_numpy(zero_copy_only=False)
    flat, ends = x.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(x.value_lengths().to_numpy()))
    if len(x) and (np.diff(ends) == ends[1]).all():
        return flat.reshape(len(x), -1)
    out = np.empty(len(x), object)
    for k in range(len(x)):
        out[k] = flat[ends[k] : ends[k + 1]]
    return out


def run_scan(columns: list[str], visit: Callable, out: pa.Schema, near: Callable | None = None, limit: int = BLOCK_ROWS, shift: int = 0):
    """A mapInArrow function over rows sorted by the column `key`.

    visit(cols, pairs) gets the columns as numpy arrays and an iterator of index pairs, and returns a dict of output
    columns. Rows of a run beyond `limit` are not paired here: the run's rows leave as they are, with heavy = true.
    Memory is bounded by the batch plus `limit` rows.
    """

    def load(table: pa.Table) -> dict[str, np.ndarray]:
        cols = {}
        for c in columns:
            cols[c] = _column(table.column(c).combine_chunks())
        return cols

    def light(table: pa.Table) -> Iterator[pa.RecordBatch]:
        key = table.column("key").combine_chunks().to_numpy(zero_copy_only=False) >> shift
        same = key[1:] == key[:-1]
        keep = np.zeros(len(key), bool)
        keep[1:] |= same
        keep[:-1] |= same
        if keep.any():
            table = table.filter(pa.array(keep))
            cols = load(table)
            made = visit(cols, _shifted_pairs(cols["key"] >> shift, near and (lambda i, j: near(cols, i, j))))
            yield from packed(made)

    def packed(made: dict) -> Iterator[pa.RecordBatch]:
        n = len(next(iter(made.values())))
        if n:
            full = [pa.array(made[f.name], f.type) if f.name in made else pa.nulls(n, f.type) for f in out]
            yield pa.RecordBatch.from_arrays(full, schema=out)

    def heavy(table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = len(table)
        full = [pa.array(np.ones(n, bool)) if f.name == "heavy" else table.column(f.name).combine_chunks().cast(f.type) if f.name in table.column_names else pa.nulls(n, f.type) for f in out]
        yield pa.RecordBatch.from_arrays(full, schema=out)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        hot = None  # key of the long run that is passing through
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if hot is not None:
                key = table.column("key").to_numpy() >> shift
                n = int(np.searchsorted(key != hot, True))
                if n:
                    yield from heavy(table.slice(0, n))
                table = table.slice(n)
                if not len(table):
                    continue
                hot = None
            held = table if held is None else pa.concat_tables([held, table])
            key = held.column("key").to_numpy() >> shift
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(starts, len(key)))
            long_runs = np.flatnonzero(sizes > limit)
            at = 0
            for r in long_runs:
                if starts[r] > at:
                    yield from light(held.slice(at, starts[r] - at))
                yield from heavy(held.slice(starts[r], sizes[r]))
                at = starts[r] + sizes[r]
                if at == len(key):
                    hot = key[-1]
            if hot is not None:
                held = None
                continue
            last = max(starts[-1], at)  # the last run may go on in the next batch
            if last > at:
                yield from light(held.slice(at, last - at))
            held = held.slice(last)
        if held is not None and len(held):
            yield from light(held)

    return scan


def run_pairs(rows: DataFrame, order: list[str], visit: Callable, out: str, name: str, near: Callable | None = None, limit: int = BLOCK_ROWS, shift: int = 0) -> DataFrame:
    """Visit every pair of rows with equal `key`, once, without making the pairs as rows.

    rows: key long (its lowest `shift` bits are payload), further columns. visit returns the few rows to keep (counts, forest links); out is their schema.
    Runs longer than `limit` are dealt out again as tiles of two blocks each, so that no task holds a whole run.
    """
    spark = rows.sparkSession
    columns = rows.columns
    fields = {f.name: f for f in spark.createDataFrame([], out).schema.fields}
    schema = spark.createDataFrame([], out).schema
    for f in rows.schema.fields:
        if f.name not in fields:
            schema = schema.add(f.name, f.dataType, True)
    schema = schema.add("heavy", "boolean", True)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    run = F.shiftright("key", shift)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = [run, *order] if shift else ["key", *order]
    first = rows.repartition(parts, run if shift else F.col("key")).sortWithinPartitions(*sort).mapInArrow(run_scan(columns, visit, arrow, near, limit, shift), schema)
    first = materialize(first, name)
    found = first.where("heavy is null").select(*fields)
    hot = first.where("heavy").select(*columns)
    if hot.isEmpty():
        return found
    # Blocks of a long run: each row joins one tile with every block of its run, its own included.
    hot = hot.withColumn("run", run)
    sizes = hot.groupBy("run").agg(F.ceil(F.count("*") / (limit // 2)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64(*[c for c in columns if c != "key"]), F.col("blocks")).cast("int")
    tiles = (
        hot.join(sizes, "run")
        .withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("tile", F.xxhash64("run", F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("cross", F.col("own") != F.col("other"))
        .drop("other", "blocks", "run")
    )

    def tile(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in order])
        cols = {}
        for c in columns:
            cols[c] = _column(table.column(c).combine_chunks())
        own, cross = table.column("own").to_numpy(), table.column("cross").to_numpy(zero_copy_only=False)

        def pairs():
            for i, j in _shifted_pairs(cols["key"] >> shift, near and (lambda i, j: near(cols, i, j))):
                ok = (own[i] != own[j]) == cross[i]
                if ok.any():
                    yield i[ok], j[ok]

        made = visit(cols, pairs())
        target = to_arrow_schema(spark_out)
        n = len(next(iter(made.values())))
        return pa.Table.from_arrays([pa.array(made[f.name], f.type) if f.name in made else pa.nulls(n, f.type) for f in target], schema=target)

    spark_out = spark.createDataFrame([], out).schema
    more = tiles.groupBy("tile").applyInArrow(tile, spark_out)
    return found.unionByName(materialize(more, f"{name}-tiles"))


# ---------------------------------------------------------------- connected components


def join_counted(rows: DataFrame, side: DataFrame, keys: list[str], count: str) -> DataFrame:
    """rows joined with side, which has few rows per key (mostly one) and tells how many of rows have it.

    A key with more rows than a partition's share would put them all in one task. There are at most as many such keys
    as partitions, so these are broadcast, and only the rest is shuffled.
    """
    share = max(1000, rows.count() // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot, rest = F.broadcast(side.where(F.col(count) > share).drop(count)), side.where(F.col(count) <= share).drop(count)
    return rows.join(hot, keys).unionByName(rows.join(hot, keys, "left_anti").join(rest, keys))


def _with_least(edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(edges with m, per node its least neighbour m): edges(u, v) joined with the least v of their u."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), f"{name}-least")
    return join_counted(edges, least, ["u"], "n"), least


def components(links: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of links(u, v).

    Alternating large-star and small-star rounds; each round is a few joins and its result a work table, so the
    number of rounds grows with the logarithm of the longest chain and nothing is gathered in one place.
    """
    edges = materialize(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        joined, low = _with_least(both, name)
        m = F.least("u", "m")
        # large star: every node's larger neighbours point to the smallest of its neighbours and itself
        large = materialize(joined.where("v > u").select(F.col("v").alias("u"), m.alias("v")).where("u <> v").distinct(), name)
        # small star: every node's smaller neighbours and itself point to the smallest of them
        joined, least = _with_least(large, name)
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        new = materialize(small.distinct(), name)
        for old in (edges, low, large, least):
            discard(old)
        edges = new
        # done when no root is itself a member and every member has one root
        if edges.select("v").distinct().join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty() and edges.groupBy("u").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(members.select(F.col("component").alias("node"), "component").distinct())
