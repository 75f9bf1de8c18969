"""Tables of text slices that meet the answers about them without a shuffle of their own.

A slice is a few megabytes of work: whole documents side by side, one row. Slice tables are bucketed by the slice's
number, so that the answers, which are small, travel to them. What a slice wants to know about the whole corpus it asks
in bulk: its keys are dealt to buckets by their digest, one row for each (bucket, slice), a bucket is answered by one
task, and the answers come back in the order of the keys. A slice asks about a key once, so a key has as many rows at
most as there are slices, and a bucket's size is set by the number of keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import materialize, work_dir

#: Bytes of text in a slice; a longer document is a slice by itself.
SLICE_BYTES = 2 << 20
#: Keys that one bucket holds.
BUCKET_KEYS = 2_000_000


def sliced(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of slices of (doc_id, text); numbers are unique in the table that one job writes."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size, number = 0, 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) if batch.num_rows else np.empty(0, np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + (not held), int(np.searchsorted(ends, before + most - size, side="right")))
            if stop > at:
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1] - before)
            if stop < batch.num_rows or size >= most:
                yield part + number, pa.Table.from_batches(held)
                held, size, number = [], 0, number + 1
            at = stop
    if held:
        yield part + number, pa.Table.from_batches(held)


def keep(df: DataFrame, name: str) -> tuple[DataFrame, Callable[[], None]]:
    """df written to the shared folder, bucketed by `slice`, and what deletes it again."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    path = f"{work_dir(spark)}/{table}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", path).option("compression", "zstd").format("parquet").bucketBy(parts, "slice").saveAsTable(table)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    return spark.table(table), drop


def bucket_count(df: DataFrame, keys: int) -> int:
    """Buckets for so many keys; small ones are spread over all tasks."""
    return max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-keys // BUCKET_KEYS))


def by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the keys by bucket, buckets that have keys, first place of each in that order and the end)."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    return order, names, np.append(first, len(bucket))


def answers(asked: DataFrame, answer: Callable[[pa.Table], list[tuple]], name: str, extra: str = "") -> tuple[DataFrame, DataFrame]:
    """(slice, answers array of (bucket, data)) for questions(bucket, slice, ...), and the table of all that `answer` gave.

    answer gets the rows of one bucket and returns a tuple (slice, bucket, data, *extra) for each.
    """
    schema = "slice long, bucket int, data binary" + extra
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(asked.sparkSession.createDataFrame([], schema).schema)

    def run(table: pa.Table) -> pa.Table:
        rows = answer(table)
        cols = zip(*rows, strict=True) if rows else [[]] * len(arrow)
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    given = materialize(asked.groupBy("bucket").applyInArrow(run, schema), name)
    each = given.where("slice is not null").groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("bucket", "data"))).alias("answers"))
    return each, given


def joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a binary column, and how many each row has."""
    parts = [np.frombuffer(x.as_buffer(), kind) for chunk in column.chunks for x in chunk]
    return (np.concatenate(parts) if parts else np.empty(0, kind)), np.array([len(p) for p in parts], np.int64)
