"""Benchmark decontamination by template canonicalisation.

Words become a template: numbers, names and units turn into typed placeholders, other words stay (small letters, no
signs). Windows of template words are hash-joined with the windows of the benchmark; a document matches an item when
it holds enough of the item's windows, and the slots must be consistent: one value of the item always meets one
value in the document, and two names never meet the same one. So a re-parameterised question is caught too. Slots are
read along the matched windows, each at its own shift; of several copies in a text one consistent copy is enough.

An item with too few literal words (fewer than LITERALS in every window) has no template and matches as it stands,
word by word.

Defined results: null and empty texts match nothing; items without words match nothing; repeated document rows give
equal rows once; repeated items match by each item_id; null ids take no part; an empty benchmark or table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import join_counted, materialize, slices, texts
from glasslake.llm.wordhash import STEP, Words, mix, windows, words

#: Words of a window, literal words that it must hold, share of an item's windows that makes a match.
WINDOW, LITERALS, SHARE = 5, 3, 0.5
#: First words of an item without a template that are hashed; the others are compared.
PREFIX = 8
#: Up to this many distinct benchmark windows (16 MB) the executors get all hashes to test against; beyond it the
#: document windows themselves are joined. Both ways give the same rows.
BROADCAST_WINDOWS = 2_000_000
#: Up to so many documents with enough windows (16 MB of ids) are picked from the corpus by a broadcast of their ids;
#: beyond it by a shuffled join.
BROADCAST_HITS = 2_000_000
#: Unit words (fixed values); a unit is one of these behind a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons pound pounds ounce ounces ml l liter liters litre litres "
    "second seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent mph kmh "
    "degree degrees celsius fahrenheit kelvin volt volts watt watts kw kwh joule joules newton newtons hz khz mhz ghz kb mb gb tb"
).split()
NUMBER, NAME, UNIT = (np.uint64(k) for k in (0xA11CE001, 0xA11CE002, 0xA11CE003))


def _unit_hashes() -> np.ndarray:
    return np.sort(words(pa.array(UNITS)).hash)


_UNIT_HASH = _unit_hashes()


def template(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each template word, and whether it is a placeholder."""
    out = w.hash.copy()
    if not len(out):
        return out, np.zeros(0, bool)
    begins = np.append(True, w.closes[:-1])
    name = w.capital & ~begins & ~w.number
    # at a sentence's start every word has a capital: there it is a name if its text has it as one elsewhere
    own = mix(w.hash + w.doc.astype(np.uint64) * STEP)
    name |= w.capital & begins & ~w.number & np.isin(own, own[name])
    unit = np.isin(w.hash, _UNIT_HASH)
    unit[1:] &= w.number[:-1] & (w.doc[1:] == w.doc[:-1])
    unit[0] = False
    out[name], out[unit], out[w.number] = NAME, UNIT, NUMBER
    return out, name | unit | w.number


def template_windows(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    w = words(column)
    t, slot = template(w)
    first, h = windows(t, w.doc, WINDOW)
    literal = np.append(0, np.cumsum(~slot))
    ok = literal[first + WINDOW] - literal[first] >= LITERALS
    return w, first[ok], h[ok]


def _position(w: Words, first: np.ndarray) -> np.ndarray:
    """Number of the word within its text."""
    heads = np.searchsorted(w.doc, w.doc[first])
    return first - heads


def _literal_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of windows of n words as they stand, apart from those of template windows."""
    return mix(h + np.uint64(0xA11CE010 + n))


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, pos, h, n): template windows (n = 0) of items, or the first n words of an item that has none."""
    for batch in batches:
        for part in slices(batch, "text"):
            w, first, h = template_windows(part.column(1))
            doc, pos, n = w.doc[first], _position(w, first), np.zeros(len(first), np.int64)
            for d in np.setdiff1d(w.doc, doc):
                low, high = np.searchsorted(w.doc, (d, d + 1))
                size = min(int(high - low), PREFIX)
                own = _literal_hash(windows(w.hash[low : low + size], w.doc[low : low + size], size)[1], size)
                doc, pos, h, n = np.append(doc, d), np.append(pos, 0), np.append(h, own), np.append(n, size)
            ids = part.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(pos.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(n.astype(np.int32))], names=["id", "pos", "h", "n"])


def _window_rows(known: np.ndarray | None, lengths: list[int]):
    """mapInArrow function (id, text) -> (id, pos, h); with known hashes only windows among them."""
    if known is not None:
        sieve = np.zeros(1 << 21, bool)
        sieve[(known & np.uint64((1 << 21) - 1)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, first, h = template_windows(part.column(1))
                ids = part.column(0).to_numpy()
                found = [(first, h)]
                for n in lengths:
                    first, h = windows(w.hash, w.doc, n)
                    found.append((first, _literal_hash(h, n)))
                for first, h in found:
                    if known is not None:
                        hit = np.flatnonzero(sieve[(h & np.uint64((1 << 21) - 1)).astype(np.int64)])
                        where = np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)
                        hit = hit[known[where] == h[hit]]
                        first, h = first[hit], h[hit]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[w.doc[first]]), pa.array(_position(w, first).astype(np.int32)), pa.array(h.view(np.int64))], names=["id", "pos", "h"])

    return run


def _values(column: pa.Array) -> list[dict[int, tuple[int, int]]]:
    """For each text: word number -> (placeholder or 0, hash of the word)."""
    w = words(column)
    t, slot = template(w)
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(column))]
    for d, p, k, h in zip(w.doc.tolist(), t.tolist(), slot.tolist(), w.hash.tolist(), strict=True):
        out[d].append((p if k else 0, h))
    return out


def consistent(item: list[tuple[int, int]], doc: list[tuple[int, int]], runs: list[list[tuple[int, int, int]]]) -> tuple[bool, int]:
    """Whether slots of the item meet consistent values in the document, and how many changed.

    runs: matched windows (first word in the document, in the item, hash), those of one run at one shift.
    """
    meets: dict[tuple[int, int], int] = {}
    names: dict[int, int] = {}
    changed: set[int] = set()
    for run in runs:
        shift = run[0][0] - run[0][1]
        for k in range(run[0][1], run[-1][1] + WINDOW):
            at = k + shift
            if k >= len(item) or not item[k][0] or not 0 <= at < len(doc) or doc[at][0] != item[k][0]:
                continue
            (kind, value), other = item[k], doc[at][1]
            if other != value:
                changed.add(k)
            if meets.setdefault((kind, value), other) != other:
                return False, len(changed)
            if kind == int(NAME) and names.setdefault(other, value) != value:
                return False, len(changed)
    return True, len(changed)


def _runs(hits: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Hits at one shift that follow each other in the item, longest run first."""
    out: list[list[tuple[int, int, int]]] = []
    for h in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        if out and out[-1][-1][0] - out[-1][-1][1] == h[0] - h[1]:
            out[-1].append(h)
        else:
            out.append([h])
    return sorted(out, key=lambda r: (-len(r), r[0]))


def _copy(runs: list[list[tuple[int, int, int]]], order: list[int]) -> tuple[list[list[tuple[int, int, int]]], set[int]]:
    """One copy of an item from the runs in this order, each window and each place once, and which runs it took from."""
    out, places, taken, used = [], set(), set(), set()
    for k in order:
        new = [h[0] not in places and h[1] not in taken for h in runs[k]]
        part: list[tuple[int, int, int]] = []
        for h, fresh in zip(runs[k], new, strict=True):
            if fresh:
                part.append(h)
                places.add(h[0])
                taken.add(h[1])
            elif part:  # what is left out ends a run
                out.append(part)
                part = []
        if part:
            out.append(part)
        if any(new):
            used.add(k)
    return out, used


def _judge(item: list[tuple[int, int]], doc: list[tuple[int, int]], hits: list[dict], least: float) -> tuple[bool, int]:
    """Whether one copy with `least` distinct windows, or all windows together, are consistent; changed slots."""
    for h in hits:
        if h["n"] and [v for _, v in item] == [v for _, v in doc[h["at"] : h["at"] + len(item)]]:
            return True, 0
    runs = _runs([(h["at"], h["pos"], h["h"]) for h in hits if not h["n"]])
    done: set[int] = set()
    by_shift = sorted((r[0][0] - r[0][1], k) for k, r in enumerate(runs))
    for k in range(len(runs)):
        if k not in done:
            # two copies are at least an item's length apart
            shift, reach = runs[k][0][0] - runs[k][0][1], len(item) // 2
            near = by_shift[bisect.bisect_left(by_shift, (shift - reach, -1)) : bisect.bisect_right(by_shift, (shift + reach, len(runs)))]
            copy, used = _copy(runs, [k, *sorted(j for _, j in near if j != k)])
            done |= used
            if len({h for run in copy for *_, h in run}) >= least:
                ok, changed = consistent(item, doc, copy)
                if ok:
                    return True, changed
    whole = _copy(runs, list(range(len(runs))))[0]
    return consistent(item, doc, whole) if len({h for run in whole for *_, h in run}) >= least else (False, 0)


def _slots(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "text")):
            items, docs = _values(part.column("item_text")), _values(part.column("text"))
            found = [_judge(i, d, h, share * n) for i, d, h, n in zip(items, docs, part.column("hits").to_pylist(), part.column("total").to_pylist(), strict=True)]
            cols = [part.column(c) for c in ("doc_id", "item_id", "windows", "share", "first_word")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.int64())], names=["doc_id", "item_id", "windows", "share", "first_word", "ok", "changed_slots"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, windows, share, first_word, changed_slots: documents that hold a benchmark item."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null").distinct()
    base = texts(docs).where("doc_id is not null")
    theirs = materialize(items.mapInArrow(_item_rows, "id long, pos int, h long, n int"), "item-windows")
    sizes = theirs.groupBy("id").agg(F.countDistinct("h").alias("total"))
    few = theirs.select("h").distinct()
    if few.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        known = np.sort(few.toArrow().column("h").to_numpy().view(np.uint64))
        if not len(known):
            return spark.createDataFrame([], "doc_id long, item_id long, windows long, share double, first_word long, changed_slots long")
    else:
        known = None
    lengths = [r.n for r in theirs.where("n > 0").select("n").distinct().collect()]
    ours = base.mapInArrow(_window_rows(known, lengths), "id long, pos int, h long").withColumnsRenamed({"id": "doc_id", "pos": "at"})
    # a window of an item may stand in very many documents
    ours = materialize(ours, "document-windows")
    standing = ours.groupBy("h").agg(F.count("*").alias("standing"))
    sought = materialize(theirs.withColumnRenamed("id", "item_id").join(standing, "h"), "item-windows-found")
    hits = join_counted(ours, sought, ["h"], "standing")
    pairs = hits.groupBy("doc_id", "item_id").agg(F.countDistinct("h").alias("windows"), F.min("at").cast("long").alias("first_word"), F.collect_set(F.struct("at", "pos", "h", "n")).alias("hits"))
    enough = pairs.join(sizes.withColumnRenamed("id", "item_id"), "item_id").withColumn("share", F.col("windows") / F.col("total")).where(F.col("share") >= share)
    enough = materialize(enough.select("doc_id", "item_id", "windows", "share", "first_word", "total", "hits"), "item-hits")
    named = items.withColumnsRenamed({"doc_id": "item_id", "text": "item_text"})
    hit = enough.select("doc_id").distinct()
    if hit.limit(BROADCAST_HITS + 1).count() <= BROADCAST_HITS:
        base = base.join(F.broadcast(hit), "doc_id", "left_semi")
    checked = enough.join(named, "item_id").join(base, "doc_id").select("doc_id", "item_id", "windows", "share", "first_word", "total", "hits", "item_text", "text")
    schema = "doc_id long, item_id long, windows long, share double, first_word long, ok boolean, changed_slots long"
    return checked.mapInArrow(_slots(share), schema).where("ok").drop("ok").distinct()
