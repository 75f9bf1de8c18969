"""Orders over whole tables without a window over a whole group: ranges, ranks and neighbours.

Rows are dealt by range, so a group may be as large as the table, and equal rows are spread too. What a partition has to
know about those before it is one row for each of them and group.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where all run in one process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="glasslake-")
        spark.conf.set("spark.checkpoint.dir", named)
    return f"{named.rstrip('/')}/lake"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: a lost executor changes nothing that was derived from it."""
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a task of a shuffle by key sorts at most, on average: some 400 bytes a row in sorts, windows and aggregates.
ROWS_OF_TASK = 500_000


def parts_of(df: DataFrame) -> int | None:
    """Partitions that so many rows need in a shuffle, or None where the session's own number will do. For tables in files:
    their rows are counted from the footers."""
    parts = -(-df.count() // ROWS_OF_TASK)
    return parts if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def by_key(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """df shuffled by key into so many partitions, so that no task outgrows its memory and spills as tables grow."""
    return df if parts is None else df.repartition(parts, *keys)


def ranged(df: DataFrame, order: list[str], name: str = "ranged") -> DataFrame:
    """df with `part` and `place`: partitions follow each other in the order of the columns, and so do the places in them.

    Rows that are alike in these columns are dealt out by where they stand in the input.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("__deal", F.monotonically_increasing_id() % 1024)
    keys = [F.col(c) for c in (*order, "__deal")]
    placed = dealt.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("__deal")
    return written(placed.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), name)


def ranks(df: DataFrame, group: list[str], order: list[str], name: str = "ranks") -> DataFrame:
    """df with `rank` (from 1) in its group by the order, and `group_rows`."""
    placed = ranged(df, [*group, *order], name)
    sizes = placed.groupBy(*group, "part").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    whole = Window.partitionBy(*group)  # one row for each partition that holds the group
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(*group, "part", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"), F.sum("rows").over(whole).alias("group_rows"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
    joined = placed.alias("l").join(offsets.alias("r"), [F.col("l.part") == F.col("r.part"), *same])
    return joined.select(*[f"l.{c}" for c in df.columns], (F.col("place") + F.col("shift")).alias("rank"), "group_rows")


def with_previous(df: DataFrame, group: list[str], order: list[str], columns: list[str], name: str = "neighbours") -> DataFrame:
    """df with last_<column>: the values of the row before it in its group, NULL for the group's first row.

    Neighbours are found inside partitions; of each partition and group one boundary row goes to the next one.
    """
    placed = ranged(df, [*group, *order], name)
    inside = Window.partitionBy("part", *group).orderBy("place")
    row = F.struct(*columns)
    lagged = placed.withColumns({"__last": F.lag(row).over(inside), "__first": F.row_number().over(inside) == 1})
    edges = placed.groupBy(*group, "part").agg(F.max_by(row, "place").alias("edge"))
    handed = edges.select(*group, "part", F.lag("edge").over(Window.partitionBy(*group).orderBy("part")).alias("handed")).where("handed is not null")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
    joined = lagged.alias("l").join(handed.alias("r"), [F.col("l.part") == F.col("r.part"), *same], "left")
    last = F.when(F.col("__first"), F.col("handed")).otherwise(F.col("__last"))
    return joined.select(*[f"l.{c}" for c in df.columns], *[last[c].alias(f"last_{c}") for c in columns])
