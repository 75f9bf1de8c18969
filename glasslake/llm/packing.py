"""Sequence packing by lexical retrieval.

Every document is tokenised whole. Windows that a document fills alone are sequences of their own; the rest of each
document goes to a sharded BM25 index: shards of bounded size hold documents with the same strongest term, a seed
document retrieves its unused neighbours of the shard, and they fill the seed's window greedily. The piece that does
not fit is cut and its rest becomes the next seed, so only the last sequence of a shard is padded.

Document frequencies cover all documents (by token id, so they are bounded by the vocabulary). Documents meet by
strongest term; a term that many documents hold is dealt to many partitions, and a partition is cut into shards as
it streams by, so a term that half of the documents share just fills many shards.

Defined results: null and empty texts are one token, the end id; repeated rows are packed once each; rows without an
id are packed under a null id; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import materialize, slices, texts
from glasslake.llm.tokens import unit_encoder

WINDOW, END_ID = 4096, 2
#: Documents of a shard, and the usual constants of BM25.
SHARD_DOCS, K1, B = 512, 1.2, 0.75

_TOKENS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, df binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def tokenized(docs: DataFrame, path: str, kind: str = "word", end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Full windows (with crc, without ids), rests (with ids) and, per task, one row of document frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = unit_encoder(path, kind)
        size = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        frequency = np.zeros(size, np.int64)
        names = [c.split()[0] for c in _TOKENS.split(", ")]
        types = [pa.int64()] * 5 + [pa.binary()] * 2
        for batch in batches:
            for part in slices(batch, "text"):
                flat, sizes = encoder.encode(part.column(1).to_pylist())
                rows, first = [], 0
                for doc, n in zip(part.column(0).to_pylist(), sizes.tolist(), strict=True):
                    ids = np.append(flat[first : first + n], np.uint32(end_id))
                    first += n
                    frequency[_terms(ids.astype("<u4" if size > 65536 else "<u2"))[0]] += 1
                    full = len(ids) // window * window
                    rows += [(doc, k, window, crc(ids[k : k + window]), len(ids), None, None) for k in range(0, full, window)]
                    if full < len(ids):
                        rows.append((doc, full, len(ids) - full, None, len(ids), ids[full:].astype("<u4" if size > 65536 else "<u2").tobytes(), None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        if frequency.any():
            yield pa.RecordBatch.from_arrays([pa.array([None], t) for t in types[:-1]] + [pa.array([frequency.astype("<i8").tobytes()])], names=names)

    return texts(docs).mapInArrow(run, _TOKENS)


def document_frequency(tokens: DataFrame) -> np.ndarray:
    """Documents that hold each token id, over all documents; as long as the vocabulary."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(0).to_pylist():
                n = np.frombuffer(x, "<i8")
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.append(at, len(n) - 1)), pa.array(np.append(n[at], 0))], names=["id", "n"])

    counts = tokens.where("df is not null").select("df").mapInArrow(spread, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(int(max(counts.column("id").to_pylist(), default=-1)) + 1, np.int64)
    out[counts.column("id").to_numpy()] = counts.column("n").to_numpy()
    return out


def _terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and how often each occurs."""
    s = np.sort(ids, kind="stable")
    head = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    return s[head], np.diff(np.append(head, len(s)))


class Shard:
    """An inverted index over the documents of one shard; scores are BM25 with corpus-wide document frequencies."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        found = [_terms(d) for d in docs]
        sizes = np.array([len(t) for t, _ in found])
        terms = np.concatenate([t for t, _ in found]).astype(np.int64)
        tf = np.concatenate([n for _, n in found]).astype(np.float64)
        length = np.repeat([len(d) for d in docs], sizes)
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))
        order = np.argsort(terms, kind="stable")
        self.doc, self.weight = np.repeat(np.arange(len(docs)), sizes)[order], weight[order]
        self.names, self.first = np.unique(terms[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(terms)))
        self.terms, self.n = [t.astype(np.int64) for t, _ in found], len(docs)

    def scores(self, seed: int) -> np.ndarray:
        at = np.searchsorted(self.names, self.terms[seed])
        count = self.count[at]
        ends = np.cumsum(count)
        rows = np.repeat(self.first[at] - (ends - count), count) + np.arange(ends[-1])
        return np.bincount(self.doc[rows], self.weight[rows], self.n)


def fill(docs: list[np.ndarray], shard: Shard, window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; all but the last sequence are full."""
    left = np.array([len(d) for d in docs])
    sequence, room, seed = 0, window, 0
    while True:
        if not left[seed]:
            rest = np.flatnonzero(left)
            if not len(rest):
                return
            seed = int(rest[0])
        rank = np.argsort(-shard.scores(seed), kind="stable")
        queue = [seed, *(k for k in rank[left[rank] > 0].tolist() if k != seed)]
        for k in queue:
            n = min(room, int(left[k]))
            yield k, len(docs[k]) - int(left[k]), n, sequence, window - room
            left[k] -= n
            room -= n
            if not room:
                sequence, room = sequence + 1, window
                seed = k  # the rest of a cut document opens the next window
                break
        else:
            return


def pack(docs: DataFrame, path: str, kind: str = "word", end_id: int = END_ID, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    table = materialize(tokenized(docs, path, kind, end_id, window), "tokens")
    frequency = document_frequency(table)
    if not len(frequency):
        return spark.createDataFrame([], _PIECES)
    n_docs = int(frequency[end_id])  # every document ends with it
    idf = np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5))
    rests = table.where("ids is not null")
    mean = float(rests.agg(F.avg("length")).first()[0] or 1.0)
    ids_type = "<u4" if len(frequency) > 65536 else "<u2"

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a term that many documents hold is dealt to so many places that each gets a partition's share at most
    places = np.maximum(1, -(-frequency * parts // n_docs))

    def strongest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            topic, place = [], []
            for doc, start, x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "ids")), strict=True):
                t, n = _terms(np.frombuffer(x, ids_type))
                topic.append(int(t[np.argmax(idf[t] * n / (n + K1))]))
                place.append(zlib.crc32(x, zlib.crc32(f"{doc}:{start}".encode())) % int(places[topic[-1]]))  # copies of a text go to different places
            yield pa.RecordBatch.from_arrays([pa.array(topic, pa.int32()), pa.array(place, pa.int32()), *batch.columns], names=["topic", "place", *batch.schema.names])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, used = TaskContext.get().partitionId() << 38, 0
        held: pa.Table | None = None

        def packed(part: pa.Table) -> pa.RecordBatch:
            nonlocal used
            ids = [np.frombuffer(x.as_py(), ids_type) for x in part.column("ids")]
            doc, start, total = (part.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
            pieces = list(fill(ids, Shard(ids, idf, mean), window))
            cols = [
                [doc[k] for k, *_ in pieces], [start[k] + s for k, s, *_ in pieces], [n for _, _, n, _, _ in pieces], [crc(ids[k][s : s + n]) for k, s, n, _, _ in pieces],
                [total[k] for k, *_ in pieces], [(space + used + q) * 2 for _, _, _, q, _ in pieces], [o for *_, o in pieces],
            ]
            used += pieces[-1][3] + 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[c.split()[0] for c in _PIECES.split(", ")])

        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            while len(held) >= SHARD_DOCS:
                yield packed(held.slice(0, SHARD_DOCS))
                held = held.slice(SHARD_DOCS)
        if held is not None and len(held):
            yield packed(held)

    keyed = rests.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(strongest, "topic int, place int, doc_id long, start long, doc_tokens long, ids binary")
    pieces = keyed.repartition(parts, "topic", "place").sortWithinPartitions("topic", "place", "doc_id", "start").mapInArrow(shards, _PIECES)
    alone = table.where("ids_crc32 is not null").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.unionByName(alone)
