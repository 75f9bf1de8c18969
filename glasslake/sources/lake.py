"""The lake's tables: Parquet tables of Spark's catalogue, laid out by batch and by bucket of customers.

Every table has two partition columns, which `read` leaves out:

- `_batch`: which write brought the row. A write that has a name of its own (a stream's micro-batch) fills the partitions
  of that name and replaces what an earlier try has left there, so it can be repeated. What has come since the last run
  is read by its batches alone.
- `_bucket`: a hash of customer_id; 0 where a table has none. A change of some customers rewrites the partitions that
  hold them and no other, by dynamic partition overwrite, so it never touches what another writer adds meanwhile.
  Parquet Bloom filters on customer_id skip row groups inside a partition.

A table built as a whole has one batch, "0". The catalogue is the session's: a persistent one keeps tables between sessions.
Each partition is replaced as one, several partitions or tables one after the other.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glasslake.operators.contracts import check_identifier
from glasslake.operators.suppression import sized

#: Buckets of customers in a table. Many make changes of few customers cheap; each is a folder for each batch.
BUCKETS = 16
LAYOUT = ["_batch", "_bucket"]
#: The batch of a table that is built as a whole.
WHOLE = "0"
#: Customers up to which a set is pushed into the scan as values, for row groups to be skipped by statistics and Bloom filters.
PUSHED_IDS = 1000
#: Ids of single rows repeat too seldom for a dictionary: building one and giving it up takes a quarter of a write.
_FILES = {"maxRecordsPerFile": "500000"} | {f"parquet.enable.dictionary#{c}": "false" for c in ("event_id", "payment_id", "order_id", "quarantine_id")}
_BLOOM = {"parquet.bloom.filter.enabled#customer_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
_REQUIRED = "glasslake.required"

Partition = tuple[str, int]


class SinkMismatch(Exception):
    """The stored table does not have the names, types, nullability or partitioning that the write expects."""


def new_batch() -> str:
    """A name for a batch that no source has named; names of later batches are greater."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Lake:
    """Tables named layer.table under one root folder, in a database of the session's catalogue."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.database = f"lake_{hashlib.md5(self.root.encode(), usedforsecurity=False).hexdigest()[:12]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}'")

    # ---- names and rows

    def table(self, name: str) -> str:
        return f"{self.database}.{check_identifier(name).replace('.', '__')}"

    def names(self) -> list[str]:
        """All stored tables."""
        return sorted(t.name.replace("__", ".", 1) for t in self.spark.catalog.listTables(self.database) if not t.isTemporary)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.table(name))

    def stored(self, name: str) -> DataFrame:
        """The rows with the columns of the layout, for reads of some batches or buckets."""
        if not self.exists(name):
            raise FileNotFoundError(name)
        return self.spark.table(self.table(name))

    def read(self, name: str) -> DataFrame:
        return self.stored(name).drop(*LAYOUT)

    def partitions(self, name: str) -> list[Partition]:
        rows = self.spark.sql(f"SHOW PARTITIONS {self.table(name)}").collect()  # one row for each folder
        return [(b.partition("=")[2], int(k.partition("=")[2])) for b, k in (r[0].split("/") for r in rows)]

    def batches(self, name: str) -> list[str]:
        return sorted({b for b, _ in self.partitions(name)}) if self.exists(name) else []

    def files(self, name: str) -> list[str]:
        """The Parquet files of the table's folder."""
        return sorted(self.stored(name).inputFiles())

    def location(self, name: str) -> str:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table(name)}")
        return described.where("col_name = 'Location'").first()["data_type"]

    def bucket(self, customer: str | Column = "customer_id") -> Column:
        return F.pmod(F.xxhash64(customer), F.lit(self.buckets)).cast("int")

    def only(self, rows: DataFrame, parts: Iterable[Partition]) -> DataFrame:
        """Rows of some partitions; other folders are not listed for the scan."""
        return rows.where(F.concat_ws("/", *LAYOUT).isin([f"{b}/{k}" for b, k in parts]))

    def of_customers(self, name: str, ids: DataFrame) -> DataFrame:
        """Stored rows of customers: their buckets alone are scanned; few customers are pushed into the scan as values."""
        rows = self.stored(name)
        wanted = [r[0] for r in ids.where("customer_id is not null").select(self.bucket().alias("b")).distinct().collect()]  # bounded by the buckets
        rows = rows.where(F.col("_bucket").isin(wanted))
        few = [r[0] for r in ids.where("customer_id is not null").select("customer_id").distinct().limit(PUSHED_IDS + 1).collect()]
        if len(few) <= PUSHED_IDS:
            return rows.where(F.col("customer_id").isin(few))
        return rows.join(sized(ids.select("customer_id").distinct()), "customer_id", "left_semi").select(*rows.columns)

    # ---- writes

    def _laid_out(self, name: str, df: DataFrame, batch: str | None, placed: bool = False) -> DataFrame:
        """df with the layout's columns; rows without a customer are spread over the buckets by their content.

        placed: each task's rows are many, or lie together by bucket as those of a stored table do: they are written from
        where they are, without a shuffle.
        """
        if batch is not None:
            if not re.fullmatch(r"[\w.-]+", batch):
                raise ValueError(f"not a name of a batch: {batch!r}")
            spread = F.coalesce(F.col("customer_id").cast("string"), F.xxhash64(*df.columns).cast("string")) if "customer_id" in df.columns else None
            df = df.withColumns({"_batch": F.lit(batch), "_bucket": self.bucket(spread) if spread is not None else F.lit(0)})
        if placed:
            # the write sorts by partition anyway; a customer's values then stand together and take less room
            return df.sortWithinPartitions(*LAYOUT, "customer_id") if "customer_id" in df.columns else df
        # one task for each partition, large ones split: a partition gets few files
        return df.hint("rebalance", *map(F.col, LAYOUT))

    def _insert(self, name: str, df: DataFrame) -> None:
        """Replace the partitions that df has rows of; a new table or new columns are made first."""
        if not self.exists(name):
            required = ",".join(f.name for f in df.schema.fields if not f.nullable and f.name not in LAYOUT)
            writer = df.write.format("parquet").partitionBy(*LAYOUT).options(**_FILES, **(_BLOOM if "customer_id" in df.columns else {}))
            writer.saveAsTable(self.table(name))
            self.spark.sql(f"ALTER TABLE {self.table(name)} SET TBLPROPERTIES ('{_REQUIRED}' = '{required}')")
            return
        have = {f.name: f.dataType for f in self.stored(name).schema.fields}
        wrong = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name in have and f.dataType != have[f.name] and not isinstance(f.dataType, T.NullType)]
        if wrong:
            raise SinkMismatch(f"{name}: stored otherwise: {', '.join(wrong)}")
        if new := [f for f in df.schema.fields if f.name not in have]:
            self.spark.sql(f"ALTER TABLE {self.table(name)} ADD COLUMNS ({', '.join(f'{check_identifier(f.name)} {f.dataType.simpleString()}' for f in new)})")
        columns = self.stored(name).schema.fields
        with _dynamic(df.sparkSession):  # a stream's batches have a session of their own
            df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in columns]).write.mode("overwrite").insertInto(self.table(name))
        # the write may have been in another session, whose listing of files is not this one's
        self.spark.catalog.refreshTable(self.table(name))

    def _drop_left(self, name: str, parts: Iterable[Partition], before: set[str]) -> None:
        """Drop those of the partitions that still hold files from before a write."""
        folders = {f.rsplit("/", 1)[0] for f in before & set(self.files(name))}
        ends = {"/".join(f.rsplit("/", 2)[-2:]) for f in folders}
        for b, k in parts:
            if f"_batch={b}/_bucket={k}" in ends:
                self.spark.sql(f"ALTER TABLE {self.table(name)} DROP IF EXISTS PARTITION (_batch = '{b}', _bucket = {k})")

    def write(self, name: str, df: DataFrame, placed: bool = False) -> DataFrame:
        """The table as a whole; placed as in _laid_out."""
        parts, before = (self.partitions(name), set(self.files(name))) if self.exists(name) else ([], set())
        self._insert(name, self._laid_out(name, df, WHOLE, placed))
        self._drop_left(name, parts, before)
        return self.read(name)

    def copy(self, name: str, source: str) -> DataFrame:
        """The stored table `source` as the table `name`: rows keep their batches and buckets, so none is shuffled."""
        parts, before = (self.partitions(name), set(self.files(name))) if self.exists(name) else ([], set())
        self._insert(name, self.stored(source))
        self._drop_left(name, parts, before)
        return self.read(name)

    def append(self, name: str, df: DataFrame, batch: str | None = None, placed: bool = False) -> DataFrame:
        """Rows as a batch; a batch that is written again replaces itself. placed as in _laid_out."""
        batch = batch or new_batch()
        parts = [p for p in self.partitions(name) if p[0] == batch] if self.exists(name) else []
        before = set(self.files(name)) if parts else set()
        self._insert(name, self._laid_out(name, df, batch, placed))
        self._drop_left(name, parts, before)
        return self.read(name)

    def insert_ignore(self, name: str, df: DataFrame, key: str, order: list[Column], batch: str | None = None) -> DataFrame:
        """First row per key wins; keys that other batches hold are left out."""
        batch, first = batch or new_batch(), first_per_key(df, key, order)
        if self.exists(name):
            # a small batch is broadcast: the stored keys are then scanned where they lie and not shuffled
            known = self.stored(name).where(F.col("_batch") != batch).select(key).join(sized(first.select(key)), key, "left_semi")
            first = first.join(known.distinct(), key, "left_anti").select(*df.columns)
        return self.append(name, first, batch)

    def replace_using(self, name: str, df: DataFrame, key: str, order: list[Column], batch: str | None = None) -> DataFrame:
        """The row with the highest order per key wins, stored or new; partitions that hold none of the keys stay as they are."""
        batch = batch or new_batch()
        if not self.exists(name):
            return self.append(name, first_per_key(df, key, order), batch)
        keys = sized(df.select(key).distinct())
        old = self.stored(name)
        # a repeated batch is taken up again with what its first try has left
        touched = [tuple(r) for r in old.join(keys, key, "left_semi").select(*LAYOUT).distinct().collect()]  # bounded by the partitions
        touched += [p for p in self.partitions(name) if p[0] == batch and p not in touched]
        mine = self.only(old, touched)
        rows = mine.drop(*LAYOUT).join(keys, key, "left_semi").unionByName(df, allowMissingColumns=True)
        winners = self._laid_out(name, first_per_key(rows, key, order), batch)
        kept = mine.join(keys, key, "left_anti").select(*old.columns)
        before = set(self.files(name))
        self._insert(name, kept.unionByName(winners, allowMissingColumns=True))
        self._drop_left(name, touched, before)
        return self.read(name)

    def rewrite(self, name: str, parts: list[Partition], change: Callable[[DataFrame], DataFrame]) -> None:
        """change() of the rows of some partitions, each in its place; emptied partitions go."""
        if parts:
            before = set(self.files(name))
            self._insert(name, change(self.only(self.stored(name), parts)).hint("rebalance", *map(F.col, LAYOUT)))
            self._drop_left(name, parts, before)

    def in_buckets(self, name: str, buckets: list[int]) -> DataFrame:
        """Stored rows of all customers of some buckets."""
        return self.stored(name).where(F.col("_bucket").isin(buckets) & F.col("customer_id").isNotNull())

    def replace_customers(self, name: str, ids: DataFrame, fresh: DataFrame, placed: bool = False, whole: bool = False) -> DataFrame:
        """The rows of customers replaced by fresh ones, in a table built as a whole: the other buckets stay as they are.

        placed as in _laid_out. whole: fresh holds the rows of all customers of the ids' buckets, and not of the ids alone.
        """
        if not self.exists(name):
            return self.write(name, fresh, placed)
        wanted = [r[0] for r in ids.select(self.bucket(F.col("customer_id")).alias("b")).distinct().collect()]  # bounded by the buckets
        old = self.stored(name).where(F.col("_bucket").isin(wanted))
        kept = old.where("customer_id is null") if whole else old.join(sized(ids.select("customer_id").distinct()), "customer_id", "left_anti").select(*old.columns)
        parts, before = [p for p in self.partitions(name) if p[1] in wanted], set(self.files(name))
        self._insert(name, kept.unionByName(self._laid_out(name, fresh, WHOLE, placed), allowMissingColumns=True))
        self._drop_left(name, parts, before)
        return self.read(name)

    def compact(self, name: str, batches: list[str]) -> None:
        """Batches as one, named as the greatest of them."""
        parts = [p for p in self.partitions(name) if p[0] in batches]
        self.rewrite(name, parts, lambda rows: rows.withColumn("_batch", F.lit(max(batches))))

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}")

    def assert_sink(self, name: str, schema: T.StructType) -> None:
        """Refuse a schema whose names, types or required columns are not the stored ones."""
        if not self.exists(name):
            return
        stored = self.stored(name)
        properties = dict(r for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.table(name)}").collect())
        required = set(filter(None, properties.get(_REQUIRED, "").split(",")))
        have = [(f.name, f.dataType.simpleString(), f.name not in required) for f in stored.schema.fields if f.name not in LAYOUT]
        want = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]
        by = [c.name for c in self.spark.catalog.listColumns(self.table(name)) if c.isPartition]
        if have != want or by != LAYOUT:
            raise SinkMismatch(f"{name}: stored {have} by {by}, expected {want} by {LAYOUT}")


def first_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
