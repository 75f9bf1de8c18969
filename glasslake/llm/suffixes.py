"""Repeated byte strings, by blockwise sorting of suffixes with a difference cover.

A byte goes if a string of `least` bytes (200) that covers it starts anywhere else too, in the same document or another.
Only the order of suffixes up to their first `least` bytes matters for that, and of the order only the ties: suffixes are
sorted by digests of a stretch of their bytes, bucket by bucket, and suffixes that tie there are repeats.

The difference cover COVERS[v] holds a few residues modulo v such that of any two places i and j, i + d and j + d are both
in the cover for some d < v. Sorting only the suffixes at cover places gives them ranks, which spare most of the others:

1. Cover suffixes are sorted by their first least - v + 1 bytes. If two strings of `least` bytes are alike, then so are two
   cover suffixes that begin up to v - 1 bytes behind their starts. So a suffix can only tie if a cover suffix that ties
   follows within v bytes; the others are left out.
2. Long ties are resolved by ranks of the cover: cover suffixes that tied are sorted by their first least + v bytes. If
   they tie again, so do the v + 1 suffixes from there on, and none of them has to be sorted. One occurrence of each
   such tie still takes part below, as other suffixes may tie with it.
3. The suffixes that are left, those near the ends of repeats, are sorted by their first `least` bytes.

In each step a bucket of suffixes is sorted by one task, with bounded memory: a bucket is a range of digests, sized by the
number of suffixes (blocks.py). A slice of documents asks for a digest once, however often it holds it, so copies
without number do not make a bucket large.

A tie of step 2 and 3 means that 64 bits of one digest and the bucket, which comes from a second one, are alike: with
buckets of BUCKET_KEYS digests one bucket in some millions holds a chance tie. Step 1 compares 40 bits, as chance ties
there only cost work.

Defined results: null texts are empty; texts under `least` bytes stay whole; rows of one id are documents of their own,
so equal rows of `least` bytes or more remove each other; a null id stays null; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.blocks import SLICE_BYTES, answers, bucket_count, by_bucket, joined, keep, sliced
from glasslake.llm.common import discard, texts
from glasslake.llm.wordhash import mix, text_bytes

#: Bytes of a repeat.
LEAST = 200
#: Perfect difference covers: every difference modulo the period comes from exactly one pair. Fixed values.
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81),
}
#: Places that are digested at a time.
CHUNK = 1 << 19
_STEPS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_SLICE = "slice long, doc_id array<long>, bounds array<long>, body binary"


@functools.cache
def _tables(which: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value of each byte, powers of the step, powers of its inverse modulo 2 ** 64)."""
    values = mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * which)) * np.uint64(_STEPS[0]))
    powers = []
    for base in (_STEPS[which], pow(_STEPS[which], -1, 2**64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        powers.append(np.multiply.accumulate(p))
    return values, *powers


def digests(body: np.ndarray, places: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Digest of the n bytes from each of the places (ascending), some CHUNK bytes at a time."""
    values, up, down = _tables(which, CHUNK + n + 1)
    out = np.empty(len(places), np.uint64)
    at = 0
    while at < len(places):
        low = int(places[at])
        stop = int(np.searchsorted(places, low + CHUNK))
        part = body[low : int(places[stop - 1]) + n]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * up[: len(part)], out=sums[1:])
        rel = places[at:stop] - low
        out[at:stop] = mix((sums[rel + n] - sums[rel]) * down[rel])
        at = stop
    return out


class Slice:
    """The bytes of some documents in a row."""

    def __init__(self, body: np.ndarray, bounds: np.ndarray, least: int, period: int) -> None:
        self.body, self.bounds, self.least, self.period = body, bounds, least, period

    def fits(self, places: np.ndarray, n: int) -> np.ndarray:
        """Those of the places from which n bytes lie in one document."""
        return places[places + n <= self.bounds[np.searchsorted(self.bounds, places, side="right")]] if len(places) else places

    def cover(self) -> np.ndarray:
        """Places of cover suffixes of the first step, counted from each document's start."""
        n = self.least - self.period + 1
        sizes = np.diff(self.bounds)
        rounds = -(-int(sizes.max(initial=0)) // self.period)
        residues = (np.arange(rounds)[:, None] * self.period + np.array(COVERS[self.period])).ravel()
        counts = np.searchsorted(residues, sizes - n, side="right")
        first = np.repeat(np.cumsum(counts) - counts, counts)
        return residues[np.arange(counts.sum()) - first] + np.repeat(self.bounds[:-1], counts)

    def runs(self, places: np.ndarray, before: int, behind: int) -> np.ndarray:
        """Whether each byte lies from `before` bytes before one of the places to `behind` bytes behind it, in its document."""
        doc = np.searchsorted(self.bounds, places, side="right")
        edge = np.zeros(len(self.body) + 1, np.int32)
        np.add.at(edge, np.maximum(places - before, self.bounds[doc - 1]), 1)
        np.add.at(edge, np.minimum(places + behind + 1, self.bounds[doc]), -1)
        return np.cumsum(edge[:-1]) > 0


class Question:
    """The digests that a slice asks about: each once, by bucket."""

    def __init__(self, body: np.ndarray, places: np.ndarray, n: int, buckets: int, exact: bool) -> None:
        self.places = places
        key = digests(body, places, n)
        if exact:
            home = digests(body, places, n, 1) % np.uint64(buckets)
        else:
            key, home = key & np.uint64((1 << 40) - 1), (key >> np.uint64(40)) % np.uint64(buckets)
        order = np.lexsort((key, home))
        new = np.flatnonzero(np.append(True, (key[order][1:] != key[order][:-1]) | (home[order][1:] != home[order][:-1]))) if len(order) else order
        self.order, self.first, self.n = order, new, np.diff(np.append(new, len(order)))
        self.width = 8 if exact else 5
        self.keys, self.home = key[order[new]], home[order[new]].astype(np.int64)

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, keys) for each bucket."""
        if len(self.home):
            _, names, first = by_bucket(self.home)
            octets = self.keys.view(np.uint8).reshape(-1, 8)[:, : self.width]
            for k, name in enumerate(names.tolist()):
                yield name, octets[first[k] : first[k + 1]].tobytes()

    def decode(self, answered: list | None) -> tuple[np.ndarray, np.ndarray]:
        """(whether each place's digest is anywhere else too, whether the place is the first that has it)."""
        again, first = np.zeros(len(self.places), bool), np.zeros(len(self.places), bool)
        if len(self.home):
            _, _, ends = by_bucket(self.home)
            bits = [np.unpackbits(np.frombuffer(a["data"], np.uint8), count=2 * int(n)).reshape(2, -1) for a, n in zip(answered, np.diff(ends), strict=True)]
            tie, chosen = np.concatenate(bits, axis=1).astype(bool)
            again[self.order] = np.repeat(tie | (self.n > 1), self.n)
            first[self.order[self.first]] = chosen
        return again, first


def _sorted_bucket(width: int):
    """Sort one bucket: for each slice's keys, which of them tie with another slice's, and which stand first."""

    def answer(table: pa.Table) -> list[tuple]:
        octets, sizes = joined(table.column("keys"), np.uint8)
        whole = np.zeros((len(octets) // width, 8), np.uint8)
        whole[:, :width] = octets.reshape(-1, width)
        keys = whole.view(np.uint64).ravel()
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        tie, first = np.zeros(len(keys), bool), np.ones(len(keys), bool)
        tie[order[1:]] |= same
        tie[order[:-1]] |= same
        first[order[1:]] = ~same
        home, at, rows = table.column("bucket")[0].as_py(), 0, []
        for s, n in zip(table.column("slice").to_pylist(), (sizes // width).tolist(), strict=True):
            rows.append((s, home, np.packbits(np.concatenate([tie[at : at + n], first[at : at + n]])).tobytes()))
            at += n
        return rows

    return answer


def _slices(slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in sliced(batches, slice_bytes):
            body, bounds = text_bytes(table.column(1).combine_chunks())
            row = [pa.array([number]), pa.array([table.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([bounds], pa.list_(pa.int64())), pa.array([body.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in _SLICE.split(", ")])

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


class Plan:
    """What the steps have in common: lengths and numbers of buckets."""

    def __init__(self, least: int, period: int, buckets: tuple[int, int, int]) -> None:
        self.least, self.period, self.buckets = least, period, buckets

    def slice_of(self, r: dict) -> Slice:
        return Slice(np.frombuffer(r["body"], np.uint8), np.array(r["bounds"], np.int64), self.least, self.period)

    def cover(self, part: Slice, r: dict) -> Question:
        return Question(part.body, part.cover(), self.least - self.period + 1, self.buckets[0], False)

    def long(self, part: Slice, r: dict) -> Question:
        tied = np.frombuffer(r["state"], np.int64)
        return Question(part.body, part.fits(tied, self.least + self.period), self.least + self.period, self.buckets[1], True)

    def rest(self, part: Slice, r: dict) -> Question:
        return Question(part.body, np.flatnonzero(self.bits(part, r)[1]), self.least, self.buckets[2], True)

    @staticmethod
    def bits(part: Slice, r: dict) -> np.ndarray:
        """Places known to tie, places left to sort."""
        return np.unpackbits(np.frombuffer(r["state"], np.uint8), count=2 * len(part.body)).reshape(2, -1).astype(bool)

    def asked(self, slices: DataFrame, question: str) -> DataFrame:
        """The rows (bucket, slice, keys) of a question."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in _rows(batches):
                found = list(getattr(self, question)(self.slice_of(r), r).rows())
                cols = [pa.array([b for b, _ in found], pa.int32()), pa.array([r["slice"]] * len(found), pa.int64()), pa.array([k for _, k in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["bucket", "slice", "keys"])

        return slices.mapInArrow(run, "bucket int, slice long, keys binary")

    def states(self, slices: DataFrame, state) -> DataFrame:
        """(slice, state, places): what state(part, row) gives, as bytes and a number."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in _rows(batches):
                made, places = state(self.slice_of(r), r)
                yield pa.RecordBatch.from_arrays([pa.array([r["slice"]]), pa.array([made], pa.binary()), pa.array([places], pa.int64())], names=["slice", "state", "places"])

        return slices.mapInArrow(run, "slice long, state binary, places long")

    def tied(self, part: Slice, r: dict) -> tuple[bytes, int]:
        """Cover suffixes that tied."""
        asked = self.cover(part, r)
        places = asked.places[asked.decode(r["answers"])[0]]
        return places.astype(np.int64).tobytes(), len(places)

    def left(self, part: Slice, r: dict) -> tuple[bytes, int]:
        """Known ties and the suffixes left to sort, as bits of the slice's bytes."""
        tied, long = np.frombuffer(r["state"], np.int64), self.long(part, r)
        again, first = long.decode(r["answers"])
        known = part.runs(long.places[again], 0, self.period)
        source = part.runs(long.places[again & first], 0, self.period)
        left = part.fits(np.flatnonzero((part.runs(tied, self.period - 1, 0) & ~known) | source), self.least)
        bits = np.zeros((2, len(part.body)), bool)
        bits[0] = known
        bits[1, left] = True
        return np.packbits(bits).tobytes(), len(left)


def _cut_rows(plan: Plan):
    """Each document's size, repeated runs of bytes, and the bytes that are left."""
    names = ["doc_id", "n_bytes", "starts", "ends", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            part = plan.slice_of(r)
            start, asked = plan.bits(part, r)[0], plan.rest(part, r)
            start[asked.places[asked.decode(r["answers"])[0]]] = True
            gone = part.runs(np.flatnonzero(start), 0, plan.least - 1)
            # a run ends with its document
            edge = np.flatnonzero(np.append(gone, False) != np.append(False, gone))
            inner = part.bounds[1:-1]
            inner = inner[(inner > 0) & (inner < len(gone))]
            inner = np.unique(inner[gone[inner] & gone[inner - 1]])
            edge = np.sort(np.concatenate([edge, inner, inner]))
            starts, ends = edge[::2], edge[1::2]
            low, high = np.searchsorted(starts, part.bounds[:-1]), np.searchsorted(starts, part.bounds[1:])
            cols: list[list] = [r["doc_id"], np.diff(part.bounds), [], [], []]
            for k in range(len(r["doc_id"])):
                a, b = part.bounds[k], part.bounds[k + 1]
                cols[2].append(starts[low[k] : high[k]] - a)
                cols[3].append(ends[low[k] : high[k]] - a)
                cols[4].append(part.body[a:b][~gone[a:b]].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return run


def period_for(least: int) -> int:
    """The longest period that leaves half of the string to the cover suffixes."""
    return max((v for v in COVERS if 2 * v <= least), default=7)


def repeated_bytes(docs: DataFrame, least: int = LEAST, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_bytes, starts and ends (array<long>: the maximal runs of removed bytes) and kept (binary: the bytes left)
    of every row of documents(doc_id, text)."""
    period = period_for(least)
    if least <= period:
        raise ValueError(f"least must be more than {period}")
    base = texts(docs)
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cover = bucket_count(docs, size * len(COVERS[period]) // period)
    slices, _ = keep(base.mapInArrow(_slices(slice_bytes), _SLICE), "suffix_slices")
    # cover suffixes
    plan = Plan(least, period, (cover, cover, cover))
    ranks, ranks_given = answers(plan.asked(slices, "cover"), _sorted_bucket(5), "suffix-ranks")
    tied, drop_tied = keep(plan.states(slices.join(ranks, "slice", "left"), plan.tied), "suffix_ties")
    discard(ranks_given)
    # long ties
    long, long_given = answers(plan.asked(slices.join(tied, "slice"), "long"), _sorted_bucket(8), "suffix-long")
    left, _ = keep(plan.states(slices.join(tied, "slice").join(long, "slice", "left"), plan.left), "suffix_left")
    drop_tied()
    discard(long_given)
    # the others
    plan = Plan(least, period, (cover, cover, bucket_count(docs, left.agg(F.sum("places")).first()[0] or 0)))
    last, _ = answers(plan.asked(slices.join(left, "slice"), "rest"), _sorted_bucket(8), "suffix-last")
    # the slices and the last answers stay in the shared folder: the result is read from them
    return slices.join(left, "slice").join(last, "slice", "left").mapInArrow(_cut_rows(plan), "doc_id long, n_bytes long, starts array<long>, ends array<long>, kept binary")
