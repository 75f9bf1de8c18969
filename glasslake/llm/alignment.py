"""How two tokenizers cut the same text: overlapping tokens, groups with equal ends, and how usual each pair of ids is.

A slice of documents is encoded by both, and every token gets its place in the bytes of the slice. A document's bytes
begin where the one before ends, so a place names its document too: places are the key of one pandas merge_asof per
direction, in which each token start finds the token of the other side that covers it. Two tokens overlap exactly if
the later of their starts lies in the other, so the two directions together give all overlaps; a link whose tokens start
alike is found by both and counted once. Ends that both sides have cut the text into groups.

The count of an id pair is the number of documents that hold it linked. A slice keeps its own dictionary of pairs and
asks for their counts in bulk (blocks.py), so that no row is made for a link, and a pair that is in every document has
one row a slice. The highest count of each id of the first tokenizer is a table as large as its vocabulary.

Defined results: texts that are null, empty or that one of the tokenizers does not give back byte for byte have no
tokens (zeros and an empty digest); strings of special tokens are plain text; rows of one id are documents of their own
and count as such, equal rows too; a null id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.blocks import SLICE_BYTES, answers, bucket_count, by_bucket, joined, keep, sliced
from glasslake.llm.common import discard, materialize, texts
from glasslake.llm.tokens import ByteEncoder
from glasslake.llm.wordhash import mix

_SLICES = (
    "slice long, doc_id array<long>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, groups_sha256 array<string>, "
    "pairs binary, entries array<int>, entry binary, times binary, bucket int, keys binary, docs binary"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_TOKENIZERS: dict[tuple[str, str], TwoTokenizers] = {}


class TwoTokenizers:
    """A byte-level vocabulary (a) over a space and the text, and a sentencepiece model (b) that sets the space itself."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.a = ByteEncoder(a_path)  # its own: added tokens are plain text here
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = self.a.token_bytes()
        n = self.b.get_piece_size()
        self.b_bytes = [bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace("▁", " ").encode() for k in range(n)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: A token as it is written in a group: followed by a comma, or by the sign that ends its side.
        self.words = [f"{k}{end}".encode() for k in range(len(self.a_bytes)) for end in ",|"] + [f"{k}{end}".encode() for k in range(n) for end in ",;"]
        self.b_word = 2 * len(self.a_bytes)

    def encode(self, column: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides for each text, empty where a side does not give the text back."""
        full = [t for t in column if t]
        other = iter(self.b.encode(full, num_threads=1) if full else [])
        left, right = [], []
        none = np.empty(0, np.int64)
        for t in column:
            a, b = none, none
            if t:
                ids, whole = next(other), b" " + t.encode()
                own = self.a.plain(" " + t)
                if b"".join([self.b_bytes[k] for k in ids]) == whole == b"".join([self.a_bytes[k] for k in own]):
                    a, b = np.array(own, np.int64), np.array(ids, np.int64)
            left.append(a)
            right.append(b)
        return left, right


def two_tokenizers(a_path: str, b_path: str) -> TwoTokenizers:
    if (a_path, b_path) not in _TOKENIZERS:
        _TOKENIZERS[a_path, b_path] = TwoTokenizers(a_path, b_path)
    return _TOKENIZERS[a_path, b_path]


def covering(starts: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each start the number of the other side's token that covers it: the last one that does not start later."""
    found = pd.merge_asof(pd.DataFrame({"at": starts}), pd.DataFrame({"at": others, "token": np.arange(len(others))}), on="at")
    return found["token"].to_numpy()


class Aligned:
    """The tokens of a slice on one line of bytes, their links and groups."""

    def __init__(self, both: TwoTokenizers, column: list[str | None]) -> None:
        left, right = both.encode(column)
        self.both, self.docs = both, len(column)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (left, right))
        self.a, self.b = (np.concatenate([*side, np.empty(0, np.int64)]).astype(np.int64) for side in (left, right))
        self.doc_a, self.doc_b = (np.repeat(np.arange(self.docs), n) for n in (self.n_a, self.n_b))
        self.a_end, self.b_end = np.cumsum(both.a_size[self.a]), np.cumsum(both.b_size[self.b])
        a_start, b_start = self.a_end - both.a_size[self.a], self.b_end - both.b_size[self.b]
        if len(self.a):
            over, under = covering(a_start, b_start), covering(b_start, a_start)
            more = np.flatnonzero(a_start[under] != b_start)
            self.link_a, self.link_b = np.concatenate([np.arange(len(self.a)), under[more]]), np.concatenate([over, more])
        else:
            self.link_a = self.link_b = np.empty(0, np.int64)
        self.last_a = self._shared(self.a_end, self.b_end)
        self.last_b = self._shared(self.b_end, self.a_end)

    @staticmethod
    def _shared(ends: np.ndarray, others: np.ndarray) -> np.ndarray:
        at = np.searchsorted(others, ends)
        return others[np.minimum(at, len(others) - 1)] == ends if len(others) else np.zeros(len(ends), bool)

    def per_doc(self, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, minlength=self.docs)

    def groups(self) -> Iterator[bytes]:
        """Each document's groups, a1,a2|b1;a3|b2,b3 in decimal ids."""
        ga, gb = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        per_a, per_b = (np.append(0, np.cumsum(np.bincount(g, minlength=int(self.last_a.sum())))) for g in (ga, gb))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + per_b[ga]] = 2 * self.a + self.last_a
        code[np.arange(len(self.b)) + per_a[gb + 1]] = self.both.b_word + 2 * self.b + self.last_b
        word, at = self.both.words, 0
        for n in (self.n_a + self.n_b).tolist():
            yield b"".join([word[k] for k in code[at : at + n].tolist()])[:-1]
            at += n

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(id pairs of the slice, entries per document; number of the pair and times linked of each entry)."""
        key = self.a[self.link_a] * len(self.both.b_bytes) + self.b[self.link_b]
        coded = pa.array(key).dictionary_encode()
        pairs, number = coded.dictionary.to_numpy(), coded.indices.to_numpy().astype(np.int64)
        line = np.sort(self.doc_a[self.link_a] * max(1, len(pairs)) + number)
        first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.empty(0, np.int64)
        doc, entry = np.divmod(line[first], max(1, len(pairs)))
        return pairs, self.per_doc(doc), entry, np.diff(np.append(first, len(line)))


def _home(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(pairs.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _encoded(a_path: str, b_path: str, buckets: int, slice_bytes: int):
    names = [c.split()[0] for c in _SLICES.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4, pa.list_(pa.string()), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = two_tokenizers(a_path, b_path)
        for number, table in sliced(batches, slice_bytes):
            x = Aligned(both, table.column(1).to_pylist())
            pairs, entries, entry, times = x.pairs()
            sha = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(x.groups(), x.n_a.tolist(), strict=True)]
            docs = np.bincount(entry, minlength=len(pairs)).astype(np.int32)
            counts = [c.astype(np.int32) for c in (x.n_a, x.n_b, x.per_doc(x.doc_a[x.last_a]), x.per_doc(x.doc_a[x.link_a]))]
            rows: list[list] = [[number, table.column(0).to_pylist(), *counts, sha, pairs.tobytes(), entries.astype(np.int32), entry.astype(np.uint32).tobytes(), times.astype(np.uint32).tobytes(), None, None, None]]
            order, homes, first = by_bucket(_home(pairs, buckets))
            for k, home in enumerate(homes.tolist()):
                at = order[first[k] : first[k + 1]]
                rows.append([number, *[None] * 10, home, pairs[at].tobytes(), docs[at].tobytes()])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return run


def _counted(b_size: int):
    """The counts of a bucket's pairs, and the highest of them for each id of the first tokenizer."""

    def answer(table: pa.Table) -> list[tuple]:
        keys, sizes = joined(table.column("keys"), np.int64)
        docs, _ = joined(table.column("docs"), np.int32)
        unique, number = np.unique(keys, return_inverse=True)
        count = np.bincount(number, weights=docs, minlength=len(unique)).astype(np.int64)
        home = table.column("bucket")[0].as_py() if len(table) else None
        own, at, rows = count[number], 0, []
        for s, n in zip(table.column("slice").to_pylist(), sizes.tolist(), strict=True):
            rows.append((s, home, own[at : at + n].tobytes(), None, None))
            at += n
        a = unique // b_size
        first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
        return [*rows, (None, home, None, a[first].astype(np.int32), np.maximum.reduceat(count, first) if len(a) else count)]

    return answer


def _scored(buckets: int, b_size: int, best):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = best.value
        for batch in batches:
            for r in batch.to_pylist():
                pairs = np.frombuffer(r["pairs"], np.int64)
                count = np.empty(len(pairs), np.int64)
                if len(pairs):
                    order, _, _ = by_bucket(_home(pairs, buckets))
                    count[order] = np.concatenate([np.frombuffer(x["data"], np.int64) for x in r["answers"]])
                entry, times = np.frombuffer(r["entry"], np.uint32).astype(np.int64), np.frombuffer(r["times"], np.uint32).astype(np.int64)
                doc = np.repeat(np.arange(len(r["doc_id"])), r["entries"])
                sums = [np.zeros(len(r["doc_id"]), np.int64) for _ in range(2)]
                np.add.at(sums[0], doc, times * (count == top[pairs // b_size])[entry])
                np.add.at(sums[1], doc, times * count[entry])
                cols = [r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], sums[0], sums[1]]
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols], pa.array(r["groups_sha256"], pa.string())], names=[c.split()[0] for c in _RESULT.split(", ")])

    return run


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id and groups, the string of each document's groups (empty without tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = two_tokenizers(a_path, b_path)
        for _, table in sliced(batches):
            yield pa.RecordBatch.from_arrays([table.column(0).combine_chunks(), pa.array([g.decode() for g in Aligned(both, table.column(1).to_pylist()).groups()], pa.string())], names=["doc_id", "groups"])

    return texts(docs).mapInArrow(run, "doc_id long, groups string")


def alignment_counts(docs: DataFrame, a_path: str, b_path: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of documents(doc_id, text).

    n_best: links whose pair's count is the highest that the first tokenizer's id has anywhere, ties included;
    count_sum: the sum of the counts over the links.
    """
    spark = docs.sparkSession
    base = texts(docs)
    # pairs of a slice are fewer than its bytes: buckets for one key in sixteen bytes hold BUCKET_KEYS each, or somewhat more
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = bucket_count(base, size // 16)
    both = two_tokenizers(a_path, b_path)
    n_a, n_b = len(both.a_bytes), len(both.b_bytes)
    table, drop = keep(base.mapInArrow(_encoded(a_path, b_path, buckets, slice_bytes), _SLICES), "alignment")
    asked = table.where("bucket is not null").select("bucket", "slice", "keys", "docs")
    each, given = answers(asked, _counted(n_b), "alignment-counts", ", a array<int>, top array<long>")
    highest = np.zeros(n_a, np.int64)
    # one row for each id of the vocabulary at most
    for r in given.where("slice is null").select(F.explode(F.arrays_zip("a", "top")).alias("x")).groupBy("x.a").agg(F.max("x.top").alias("top")).collect():
        highest[r["a"]] = r["top"]
    rows = table.where("bucket is null").drop("bucket", "keys", "docs").join(each, "slice", "left")
    out = rows.mapInArrow(_scored(buckets, n_b, spark.sparkContext.broadcast(highest)), _RESULT)
    out = materialize(out, "alignment")
    drop()
    discard(given)
    return out
