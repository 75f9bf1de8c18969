"""Token ids in fixed-width bit packing.

Each id takes the fewest bits that hold the vocabulary. Ids are written in blocks of whole documents, in ascending
doc_id order; a block row names its documents, where each begins in it and how many ids of its shard come before it.
Unpacking a block is a few numpy calls, and one document is read by pruning to its block and unpacking its slice.

Defined results: null and empty texts are the end id alone; null ids sort first and are kept; repeated rows are kept
once each, in equal order of text; an empty table gives no blocks; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glasslake.llm.common import slices, texts
from glasslake.llm.tokens import unit_encoder

BLOCK_IDS = 65_536
_BLOCK = "shard int, block int, first_id long, n_ids long, bits int, min_doc long, max_doc long, doc_ids array<long>, doc_starts array<long>, payload binary"


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a little-endian bit stream of `bits` bits each."""
    ids = np.asarray(ids, np.uint32)
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_ids(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop of a packed stream; only their bytes are touched."""
    if bits in (8, 16, 32):
        width = bits // 8
        return np.frombuffer(payload, f"<u{width}", stop - start, start * width).astype(np.uint32)
    first = start * bits // 8
    raw = np.frombuffer(payload, np.uint8)[first : -(-stop * bits // 8)]
    flat = np.unpackbits(raw, bitorder="little")[start * bits - first * 8 :][: (stop - start) * bits]
    return flat.reshape(-1, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, kind: str = "byte", end_id: int = 0) -> None:
    """Tokenise whole texts and write them as packed blocks, in ascending doc_id order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(tokenizer, kind)
        bits = max(1, (max(encoder.tokenizer.get_vocab_size(), end_id + 1) - 1).bit_length())
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        held, docs, starts, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            real = [d for d in docs if d is not None]
            cols = [[shard], [block], [before], [n], [bits], [min(real, default=None)], [max(real, default=None)], [docs], [starts], [pack_ids(np.concatenate(held), bits)]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            for part in slices(batch, "text"):
                flat, sizes = encoder.encode(part.column(1).to_pylist())
                first = 0
                for doc, size in zip(part.column(0).to_pylist(), sizes.tolist(), strict=True):
                    docs.append(doc)
                    starts.append(n)
                    held += [flat[first : first + size], np.array([end_id], np.uint32)]
                    first += size
                    n += size + 1
                    if n >= BLOCK_IDS:
                        yield flush()
                        block, before = block + 1, before + n
                        held, docs, starts, n = [], [], [], 0
        if n:
            yield flush()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(run, _BLOCK).write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(row["payload"], row["bits"], 0, row["n_ids"]).astype("<u4")
                bounds = [*row["doc_starts"], row["n_ids"]]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
                start = np.array(row["doc_starts"], np.int64) + row["first_id"]
                shard = np.full(len(start), row["shard"], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(shard), pa.array(start), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())], names=["doc_id", "shard", "at", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema(_BLOCK).parquet(path)
    # one row per shard, as many as the writer had tasks: the ids of all shards before it
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    base = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))
    docs = blocks.mapInArrow(run, "doc_id long, shard int, at long, n_tokens long, ids_crc32 long")
    return docs.join(base, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document (one array per row of that id): only its block is read."""
    rows = spark.read.schema(_BLOCK).parquet(path).where((F.col("min_doc") <= doc_id) & (F.col("max_doc") >= doc_id)).where(F.array_contains("doc_ids", doc_id)).collect()
    out = []
    for row in rows:
        bounds = [*row.doc_starts, row.n_ids]
        out += [unpack_ids(row.payload, row.bits, bounds[k], bounds[k + 1]) for k, d in enumerate(row.doc_ids) if d == doc_id]
    return out
