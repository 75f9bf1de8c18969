"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint is cut into few segments, so few that one of them differs by at most one bit. Each segment is indexed
once per bit, with that bit blanked: two segments that differ by at most one bit share a variant, so an equality
join finds the pair and the whole fingerprints verify it.

Two uses: `bits=64, segments=2` is exact for links of up to 3 differing bits (3 = 2 * segments - 1). For a shingle
similarity, `similar_documents` takes a longer fingerprint with more segments, chosen by recall, and verifies
candidates by the shingles themselves.

Defined results: null text counts as empty; no words give fingerprint zero; fewer words than a shingle give one
shingle of all words; a null id takes no part in links (its component is null); repeated rows of one id are one document with equal rows;
an empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import components, discard, forest, join_counted, materialize, run_pairs, slices, texts

SEED = 42
#: Multipliers of the splitmix64 finaliser, which spreads one 64-bit hash to further words.
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Row b holds, in byte j, bit 7 - j of b: adding rows counts eight bits at once.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of lower-cased (A-Z) words, repeats included, in order."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(parts)
    digest = xxhash.xxh64_intdigest
    if n <= words:
        return np.array([digest(b" ".join(parts), SEED)] if n else [], np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: n - words + 1].tolist()
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)), np.uint64, n - words + 1)


def widen(h: np.ndarray, words: int) -> np.ndarray:
    """(n, words) 64-bit words per hash: the hash itself, then mixed forms of it."""
    out = np.empty((len(h), words), np.uint64)
    out[:, 0] = h
    for k in range(1, words):
        x = h + np.uint64(0x9E3779B97F4A7C15 * k % 2**64)
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        out[:, k] = x ^ (x >> np.uint64(31))
    return out


def fingerprints(hashes: list[np.ndarray], words: int) -> np.ndarray:
    """(documents, words) fingerprints: a bit is 1 if set in over half of the document's hashes."""
    out = np.zeros((len(hashes), words), np.uint64)
    sizes = np.array([len(h) for h in hashes], np.int64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    wide = widen(np.concatenate([hashes[i] for i in full]), words)
    octets = wide.byteswap().view(np.uint8).reshape(len(wide), words * 8)
    first = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
    # counters of one byte hold 255 rows at most
    chunks = np.concatenate([np.arange(a, a + n, 255) for a, n in zip(first, sizes[full], strict=True)])
    counts = np.add.reduceat(SPREAD[octets], chunks, axis=0).view(np.uint8).reshape(len(chunks), words * 64)
    total = np.add.reduceat(counts, np.searchsorted(chunks, first), axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > sizes[full][:, None], axis=1)
    out[full] = bits.reshape(len(full), words, 8).view(">u8").reshape(len(full), words)
    return out


def fingerprint_table(docs: DataFrame, shingle: int = 3, bits: int = 64) -> DataFrame:
    """doc_id, fp array<long> (bits / 64 words) and n_shingles of every row of documents(doc_id, text)."""
    words = bits // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes = [shingle_hashes(t, shingle) for t in part.column(1).to_pylist()]
                flat = fingerprints(hashes, words).view(np.int64).ravel()
                fp = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, words, dtype=np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), fp, pa.array([len(h) for h in hashes], pa.int64())], names=["doc_id", "fp", "n_shingles"])

    return texts(docs).mapInArrow(run, "doc_id long, fp array<long>, n_shingles long")


def hamming_links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(u, v) forest links between distinct 64-bit fingerprints (column fp long) at max_bits or fewer differing bits.

    Exact for max_bits <= 3: of two halves one differs by at most one bit. The links connect exactly the groups that
    all links connect; a star per block of a run stands for the links inside it.
    """
    assert max_bits <= 3, "two segments cover three differing bits"
    half = F.when(F.col("p") < 32, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    blank = F.expr("shiftleft(1L, pmod(p, 32))")
    keys = (
        prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("p"))
        .withColumn("half", half)
        .select((F.shiftleft(F.col("p").cast("long"), 32)).bitwiseOR(F.col("half").bitwiseAND(F.bitwise_not(blank))).alias("key"), "fp")
    )

    def visit(cols, pairs):
        key, fp = cols["key"], cols["fp"].view(np.uint64)
        p = (key >> 32).astype(np.int64)
        shift = np.where(p < 32, 0, 32).astype(np.uint64)
        bit = (p % 32).astype(np.uint64)
        links = _Links()
        for i, j in pairs:
            x = fp[i] ^ fp[j]
            seg = (x >> shift[i]) & np.uint64(0xFFFFFFFF)
            # equal segments share all 32 variants: only the first counts
            ok = (np.bitwise_count(x) <= max_bits) & ((seg != 0) | (bit[i] == 0))
            if ok.any():
                links.add(cols["fp"][i[ok]], cols["fp"][j[ok]])
        return links.columns()

    return run_pairs(keys, ["fp"], visit, "u long, v long", "simhash-links")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fp long, component_id: groups of documents linked at max_bits or fewer of 64 bits."""
    table = materialize(fingerprint_table(docs, shingle).select("doc_id", F.col("fp")[0].alias("fp")), "simhash")
    first = materialize(table.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "simhash-prints")
    groups = components(hamming_links(first.select("fp"), max_bits), "simhash-components")
    # the group's name is the smallest doc_id, not the smallest fingerprint
    named = first.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_print = materialize(named.join(least, "component").select("fp", "n", "component_id"), "simhash-named")
    named = join_counted(table.where("doc_id is not null"), by_print, ["fp"], "n").select("doc_id", "fp", "component_id")
    return named.unionByName(table.where("doc_id is null").select("doc_id", "fp", F.lit(None).cast("long").alias("component_id")))


# ---------------------------------------------------------------- a similarity of shingle sets

#: Probability that a pair at the similarity shares a variant; candidates that a document may meet by chance; least
#: bits of a segment.
WIDE_RECALL, WIDE_CHANCE, WIDE_BITS = 0.94, 4096, 19
#: Standard deviations above the mean by which a candidate's bits may differ.
DEVIATIONS = 3.0
#: Few shingles make rough fingerprints: pairs of which one set has up to so many are joined exactly.
SHORT_SET = 16


@dataclass(frozen=True)
class Layout:
    """Segments, bits of each, words of a fingerprint (two more than the segments fill, to check candidates by).

    An index entry is a key, the variant's number and value above `shift` check bits, and 64 more check bits. check and
    whole are the most bits that may differ among the check bits and in the whole fingerprint.
    """

    segments: int
    bits: int
    words: int
    shift: int
    check: int
    whole: int


def layout(n: int, similarity: float) -> Layout:
    """Sized for n classes: segments are so long that a document meets WIDE_CHANCE others by chance at most, and so many
    that a pair at the similarity shares a variant with probability WIDE_RECALL. So work grows with n, not its square."""
    # bits differ as often as the angle between the shingle sets says
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits, segments = WIDE_BITS - 1, 0
    while not segments or (n * segments * (bits + 1) / 2**bits > WIDE_CHANCE and bits < 40):
        bits += 1
        shares = (1 - p) ** bits + bits * p * (1 - p) ** (bits - 1)
        segments = round(math.log(1 - WIDE_RECALL) / math.log(1 - shares))
    shift, words = 63 - bits - (segments * bits - 1).bit_length(), -(-(segments * bits) // 64) + 2
    most = lambda m: math.ceil(m * p + DEVIATIONS * math.sqrt(m * p * (1 - p)))
    return Layout(segments, bits, words, shift, most(shift + 64), most(64 * words))


def _segments(fp: np.ndarray, plan: Layout) -> np.ndarray:
    """(n, segments) values of plan.bits bits each, from all but the last two words."""
    bits = np.unpackbits(np.ascontiguousarray(fp[:, :-2]).byteswap().view(np.uint8).reshape(len(fp), -1), axis=1)[:, : plan.segments * plan.bits]
    return bits.reshape(len(fp), plan.segments, plan.bits).astype(np.int64) @ (1 << np.arange(plan.bits, dtype=np.int64))


def _list_array(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(rows.view(np.int64).ravel()))


def _shingle_sets(shingle: int, plan: Layout, with_sets: bool, most: int = 0):
    """Fingerprints, with the sets themselves, or with digests and the sets of up to `most` shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [np.unique(shingle_hashes(t, shingle)) for t in part.column("text").to_pylist()]
                fp = _list_array(fingerprints(sets, plan.words))
                if with_sets:
                    ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                    flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.array([], np.uint64)]).view(np.int64)))
                    yield pa.RecordBatch.from_arrays([part.column("key"), part.column("rep"), fp, flat], names=["key", "rep", "fp", "set"])
                else:
                    digest = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                    short = pa.array([s.view(np.int64) if len(s) <= most else None for s in sets], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), digest, fp, short], names=["doc_id", "digest", "fp", "short"])

    return run


def _variants(plan: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = ~(np.int64(1) << np.arange(plan.bits, dtype=np.int64))
        per = plan.segments * plan.bits
        head = (np.arange(per) << plan.bits).reshape(plan.segments, plan.bits)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fp = part.column(1).flatten().to_numpy().view(np.uint64).reshape(part.num_rows, plan.words)
                key = ((_segments(fp, plan)[:, :, None] & blank) | head) << plan.shift
                key |= (fp[:, -2] >> np.uint64(64 - plan.shift)).astype(np.int64)[:, None, None]
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(part.column(0).to_numpy(), per)), pa.array(np.repeat(fp[:, -1].view(np.int64), per))], names=["key", "rep", "mark"])

    return run


class _Links:
    """Links gathered as stars: never more than a million rows at a time."""

    def __init__(self) -> None:
        self.u, self.v, self.n = [], [], 0

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        self.u.append(u)
        self.v.append(v)
        self.n += len(u)
        if self.n > 1_000_000:
            u, v = self.stars()
            self.u, self.v, self.n = [u], [v], len(u)

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.u:
            return np.array([], np.int64), np.array([], np.int64)
        return forest(np.concatenate(self.u), np.concatenate(self.v))

    def columns(self) -> dict[str, np.ndarray]:
        u, v = self.stars()
        return {"u": u, "v": v}


def _candidate_visit(plan: Layout):
    def visit(cols, pairs):
        low = np.uint64((1 << plan.shift) - 1)
        key, mark = cols["key"].view(np.uint64) & low, cols["mark"].view(np.uint64)
        links = _Links()
        for i, j in pairs:
            ok = np.bitwise_count(key[i] ^ key[j]) + np.bitwise_count(mark[i] ^ mark[j]) <= plan.check
            if ok.any():
                links.add(cols["rep"][i[ok]], cols["rep"][j[ok]])
        return links.columns()

    return visit


def _near_centre(similarity: float):
    """rep, key and whether the shingle set is near that of its group's smallest class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                near = [_alike(_set(part.column("set"), k), _set(part.column("centre"), k), similarity) for k in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("rep"), pa.array(near, pa.bool_())], names=["key", "rep", "near"])

    return run


def _set(column: pa.Array, k: int) -> np.ndarray:
    return column[k].values.to_numpy(zero_copy_only=False)


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


#: Rows on the two sides of a tile, and bytes of shingles that a side may hold (one set at least).
TILE_FAR, TILE_ALL, TILE_BYTES = 64, 256, 16 << 20


def _tile_links(plan: Layout, similarity: float):
    """Links of a tile: its far classes with all of its other classes."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        far = table.column("far").to_numpy(zero_copy_only=False)
        rep, fp, sets = table.column("rep").to_numpy(), table.column("fp").combine_chunks(), table.column("set").combine_chunks()
        marks = fp.flatten().to_numpy().view(np.uint64).reshape(len(rep), plan.words)
        label, links = np.arange(len(rep)), _Links()
        for i in np.flatnonzero(far).tolist():
            close = np.flatnonzero((np.bitwise_count(marks ^ marks[i]).sum(axis=1) <= plan.whole) & (rep != rep[i]))
            for j in close.tolist():
                # another link has joined them already, or not
                if label[i] != label[j] and _alike(_set(sets, i), _set(sets, j), similarity):
                    label[label == label[j]] = label[i]
                    links.add(rep[[i]], rep[[j]])
        found = links.columns()
        return pa.Table.from_arrays([pa.array(found["u"], pa.int64()), pa.array(found["v"], pa.int64())], schema=out)

    return run


def _verified(base: DataFrame, groups: DataFrame, shingle: int, plan: Layout, similarity: float) -> DataFrame:
    """(u, v) links that connect what all pairs of a candidate group at the similarity connect.

    Each class is compared with its group's smallest one. Those near it are connected by that, whatever links there are
    among them, so only pairs with a class that is far from it are left. These are compared in tiles of bounded rows and
    bytes, so that no task holds a group.
    """
    sizes = materialize(groups.groupBy("key").agg(F.count("*").alias("n")), "wide-sizes")
    rows = base.withColumnRenamed("doc_id", "rep").join(groups, "rep").select("key", "rep", "text").mapInArrow(_shingle_sets(shingle, plan, True), "key long, rep long, fp array<long>, set array<long>")
    rows = materialize(rows.dropDuplicates(["rep"]), "wide-sets")
    centres = materialize(rows.where("rep = key").select("key", F.col("set").alias("centre")).join(sizes, "key"), "wide-centres")
    pairs = join_counted(rows.where("rep <> key"), centres, ["key"], "n").select("key", "rep", "set", "centre")
    near = materialize(pairs.mapInArrow(_near_centre(similarity), "key long, rep long, near boolean"), "wide-near")
    # groups that have far classes, in blocks of both sides
    far = F.coalesce(~F.col("near"), F.lit(False))
    marked = rows.join(near.select("rep", "near"), "rep", "left").withColumn("far", far).withColumn("bytes", 8 * F.size("set"))
    blocks = lambda rows_of, most, bytes_of: F.greatest(F.ceil(rows_of / most), F.ceil(bytes_of / TILE_BYTES)).cast("int")
    open_groups = marked.groupBy("key").agg(F.count_if("far").alias("n_far"), F.coalesce(F.sum(F.when(F.col("far"), F.col("bytes"))), F.lit(0)).alias("far_bytes"), F.count("*").alias("n"), F.sum("bytes").alias("all_bytes")).where("n_far > 0")
    open_groups = materialize(open_groups.select("key", "n", blocks(F.col("n_far"), TILE_FAR, F.col("far_bytes")).alias("far_blocks"), blocks(F.col("n"), TILE_ALL, F.col("all_bytes")).alias("all_blocks")), "wide-open")
    held = join_counted(marked.select("key", "rep", "fp", "set", "far"), open_groups, ["key"], "n")
    own = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    left = held.where("far").select("*", own(F.col("far_blocks")).alias("a"), F.explode(each(F.col("all_blocks"))).alias("b"))
    right = held.select("*", own(F.col("all_blocks")).alias("b"), F.explode(each(F.col("far_blocks"))).alias("a")).withColumn("far", F.lit(False))
    tiles = left.unionByName(right).withColumn("tile", F.xxhash64("key", "a", "b")).select("tile", "rep", "fp", "set", "far")
    links = materialize(tiles.groupBy("tile").applyInArrow(_tile_links(plan, similarity), "u long, v long"), "wide-verified")
    out = near.where("near").select(F.col("rep").alias("u"), F.col("key").alias("v")).unionByName(links)
    return materialize(out, "wide-links-verified")


def _prefix_rows(similarity: float, most: int):
    """Each short set under its first shingles: two sets at the similarity share one of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(r, np.sort(np.array(s, np.int64).view(np.uint64)).view(np.int64)) for r, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if s]
            count = np.array([len(s) - math.ceil(similarity * len(s) - 1e-9) + 1 for _, s in rows], np.int64)
            padded = np.zeros((len(rows), most), np.int64)
            for k, (_, s) in enumerate(rows):
                padded[k, : len(s)] = s
            key = np.concatenate([np.empty(0, np.int64), *(s[:n] for (_, s), n in zip(rows, count, strict=True))])
            rep, size = np.array([r for r, _ in rows], np.int64), np.array([len(s) for _, s in rows], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(rep, count)), pa.array(np.repeat(size, count)), _list_array(np.repeat(padded, count, axis=0))], names=["key", "rep", "size", "set"])

    return run


def _prefix_visit(similarity: float):
    def visit(cols, pairs):
        rep, size, sets = cols["rep"], cols["size"].astype(np.int64), cols["set"]
        place = np.arange(sets.shape[1])
        links = _Links()
        for i, j in pairs:
            low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
            fits = (low <= SHORT_SET) & (low >= similarity * high - 1e-9)
            i, j = i[fits], j[fits]
            for at in range(0, len(i), 4096):
                a, b = i[at : at + 4096], j[at : at + 4096]
                same = (sets[a][:, :, None] == sets[b][:, None, :]) & (place < size[a][:, None])[:, :, None] & (place < size[b][:, None])[:, None, :]
                both = same.sum(axis=(1, 2))
                ok = both >= similarity * (size[a] + size[b] - both) - 1e-9
                if ok.any():
                    links.add(rep[a[ok]], rep[b[ok]])
        return links.columns()

    return visit


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, component_id: groups of documents linked at a Jaccard similarity of their shingle sets.

    Equal shingle sets are one class (128-bit digest; texts without words are one class). Classes get a wide
    fingerprint: its segments, sized for the table by layout(), are indexed by deletion variants, the rest checks
    candidates, and the shingle sets themselves decide. Candidates come with probability WIDE_RECALL at the similarity
    and more above it; pairs with a set of up to SHORT_SET shingles are found exactly, by a shared shingle of their
    prefixes.
    """
    most = math.floor(SHORT_SET / similarity + 1e-9)
    base = texts(docs).where("doc_id is not null")
    plan = layout(base.count(), similarity)
    table = materialize(base.mapInArrow(_shingle_sets(shingle, plan, False, most), "doc_id long, digest binary, fp array<long>, short array<long>"), "wide")
    classes = materialize(table.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.any_value("fp").alias("fp"), F.any_value("short").alias("short"), F.count("*").alias("n")), "wide-classes")
    prefixes = classes.where("size(short) > 0").select("rep", "short").mapInArrow(_prefix_rows(similarity, most), "key long, rep long, size int, set array<long>")
    exact = run_pairs(prefixes, ["rep"], _prefix_visit(similarity), "u long, v long", "short-links")
    keys = classes.select("rep", "fp").mapInArrow(_variants(plan), "key long, rep long, mark long")
    candidates = run_pairs(keys, ["rep"], _candidate_visit(plan), "u long, v long", "wide-links", shift=plan.shift)
    groups = components(candidates, "wide-candidates").select(F.col("node").alias("rep"), F.col("component").alias("key"))
    links = _verified(base, groups, shingle, plan, similarity)
    found = components(links.unionByName(exact), "wide-components").select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
    by_class = materialize(classes.select("digest", "rep", "n").join(found, "rep", "left").select("digest", "n", F.coalesce("component_id", "rep").alias("component_id")), "wide-named")
    out = materialize(join_counted(table.select("doc_id", "digest"), by_class, ["digest"], "n").select("doc_id", "component_id"), "similar")
    discard(by_class, table, classes, exact, candidates, groups, links, found)
    return out
