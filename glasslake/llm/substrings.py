"""Substring dedup by hashing normalised units: lines, paragraphs, sentences inside lines, or windows of words.

`repeated_passages` is the whole job: every line of least_line words or more that occurs earlier as a line, and every
run of LEAST_WORDS words or more that occurs earlier anywhere, from its first to its last word. `repeated_spans` is the
plainer form on one kind of unit.

Units are normalised (small letters of any script; signs and white space do not count) and their digests grouped globally. The
earliest occurrence, by (doc_id, position), stays; the others are removed as runs of neighbouring units, with their
offsets in the original text.

A hot line is pre-aggregated before the shuffle, and the join back takes it from a broadcast, so no group of
occurrences is ever held in one place.

Defined results: null and empty texts have no units; units without letters or digits are none; repeated rows of one
id are one document; null ids take no part; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glasslake.llm.common import join_counted, materialize, slices, texts
from glasslake.llm.wordhash import Words, mix, text_bytes, windows, words

#: Words that a run of repeated units must hold to be removed.
LEAST_WORDS = 17
#: Words that a repeated line must hold; shorter ones ("Les.") are alike by chance. 1 reports every repeated line.
LEAST_LINE = 5
#: Sentences are also cut behind one word in so many, chosen by the word itself, so that text without stops has units.
CUT_EVERY = 32
#: Windows of so many words are hashed, and of as many neighbouring windows those with the least hash are kept. So a run
#: of 2 * ANCHOR - 1 = LEAST_WORDS words always holds a kept window, the same one in all its copies, and kept windows of
#: a run leave no word between them uncovered and fewer than ANCHOR words at its ends.
ANCHOR = (LEAST_WORDS + 1) // 2
_ANCHORS = "doc_id long, at int, n int, d1 long, d2 int, start int, end int, again boolean"
_ENDS = "doc_id long, d1 long, at int, place int, before array<long>, behind array<long>, starts array<int>, ends array<int>"
_UNITS = "doc_id long, unit int, d1 long, d2 int, start int, end int, n_words int, again boolean"
_PRIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _powers(n: int, step: np.uint64) -> np.ndarray:
    out = np.full(max(n, 1), step, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def unit_rows(column: pa.Array, unit: str = "sentence") -> dict[str, np.ndarray]:
    """doc (number of the text), unit (number in its text), digests, code point offsets, words, and whether the text has it before."""
    w = words(column)
    n = len(w.hash)
    if not n:
        return {k: np.empty(0, np.int64) for k in ("doc", "unit", "d1", "d2", "start", "end", "n_words", "again")}
    _, bounds = text_bytes(column)
    lines = np.cumsum(w.data == ord("\n"))
    new_line = np.append(True, lines[w.start[1:]] != lines[w.start[:-1]])
    if unit == "paragraph":
        new_line = np.append(True, lines[w.start[1:]] - lines[w.end[:-1] - 1] >= 2)
    begins = new_line | np.append(True, w.doc[1:] != w.doc[:-1])
    if unit == "sentence":
        begins[1:] |= w.closes[:-1] | (w.hash[:-1] % np.uint64(CUT_EVERY) == 0)
    first = np.flatnonzero(begins)
    size = np.diff(np.append(first, n))
    at = np.arange(n) - np.repeat(first, size)
    d1, d2 = (mix(np.add.reduceat(w.hash * _powers(int(size.max()), p)[at], first) + np.uint64(k)) for k, p in enumerate(_PRIMES))
    lead = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
    doc = w.doc[first]
    base = lead[bounds[doc]]
    number = np.arange(len(first)) - np.searchsorted(doc, doc)
    order = np.lexsort((np.arange(len(first)), d1, doc))
    again = np.zeros(len(first), bool)
    again[order[1:]] = (doc[order[1:]] == doc[order[:-1]]) & (d1[order[1:]] == d1[order[:-1]]) & (d2[order[1:]] == d2[order[:-1]])
    return {"again": again, "doc": doc, "unit": number, "d1": d1.view(np.int64), "d2": (d2 >> np.uint64(32)).astype(np.uint32).view(np.int32), "start": lead[w.start[first]] - base, "end": lead[w.end[first + size - 1]] - base, "n_words": size}


def _units(unit: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                u = unit_rows(part.column(1), unit)
                ids = part.column(0).to_numpy()
                small = [pa.array(u[k].astype(np.int32)) for k in ("start", "end", "n_words")] + [pa.array(u["again"].astype(bool))]
                yield pa.RecordBatch.from_arrays([pa.array(ids[u["doc"]]), pa.array(u["unit"].astype(np.int32)), pa.array(u["d1"].astype(np.int64)), pa.array(u["d2"].astype(np.int32)), *small], names=[c.split()[0] for c in _UNITS.split(", ")])

    return run


def _later(rows: DataFrame) -> DataFrame:
    """rows(doc_id, d1, d2, again) that are not the first of their digest, with the document that has the first."""
    seen = rows.groupBy("d1", "d2").agg(F.min("doc_id").alias("kept_doc_id"), F.count("*").alias("n_rows")).where("n_rows > 1")
    return join_counted(rows, materialize(seen, "seen"), ["d1", "d2"], "n_rows").where("again OR doc_id <> kept_doc_id")


def repeated_spans(docs: DataFrame, unit: str = "sentence", least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, start, end (code points, end exclusive), n_words, kept_doc_id of every span to remove.

    kept_doc_id is the document that keeps the span's first unit: the first one that has it anywhere.
    Repeats inside a document are found where its text is read.
    """
    found = texts(docs).where("doc_id is not null").mapInArrow(_units(unit), _UNITS)
    units = materialize(found, "units")
    columns = ["doc_id", "unit", "start", "end", "n_words", "kept_doc_id"]
    extra = _later(units).select(columns).distinct()  # repeated rows are one document
    by_doc = Window.partitionBy("doc_id").orderBy("unit")
    runs = extra.withColumn("run", F.col("unit") - F.dense_rank().over(by_doc))
    spans = runs.groupBy("doc_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_words").alias("n_words"), F.min_by("kept_doc_id", "unit").alias("kept_doc_id"))
    return spans.where(F.col("n_words") >= least_words).drop("run")


# ---------------------------------------------------------------- lines and runs of words


def _repeats(doc: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """Whether the same digest comes before in the same text."""
    order = np.lexsort((np.arange(len(doc)), d2, d1, doc))
    again = np.zeros(len(doc), bool)
    again[order[1:]] = (doc[order[1:]] == doc[order[:-1]]) & (d1[order[1:]] == d1[order[:-1]]) & (d2[order[1:]] == d2[order[:-1]])
    return again


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words and digests of the kept windows (ties are kept too)."""
    first, d1 = windows(w.hash, w.doc, ANCHOR)
    m = len(first) - ANCHOR + 1
    keep = np.zeros(len(first), bool)
    if m > 0:
        least = d1[:m].copy()
        for k in range(1, ANCHOR):
            np.minimum(least, d1[k : k + m], out=least)
        whole = w.doc[first[:m]] == w.doc[first[ANCHOR - 1 :]]
        for k in range(ANCHOR):
            keep[k : k + m] |= whole & (d1[k : k + m] == least)
    first, d1 = first[keep], d1[keep]
    d2 = np.zeros(len(first), np.uint64)
    for k in range(ANCHOR):
        d2 += (w.hash[first + k] ^ _PRIMES[0]) * _powers(ANCHOR, _PRIMES[1])[k]
    return first, d1, mix(d2)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (n words, with offsets) and kept windows (n = 0)."""
    for batch in batches:
        for part in slices(batch, "text"):
            text = part.column(1)
            w = words(text, chars=True)
            if not len(w.hash):
                continue
            ids = part.column(0).to_numpy()
            head = np.searchsorted(w.doc, np.arange(len(text)))
            _, bounds = text_bytes(text)
            lines = np.cumsum(w.data == ord("\n"))
            first = np.flatnonzero(np.append(True, (lines[w.start[1:]] != lines[w.start[:-1]]) | (w.doc[1:] != w.doc[:-1])))
            size = np.diff(np.append(first, len(w.hash)))
            at = np.arange(len(w.hash)) - np.repeat(first, size)
            d1, d2 = (mix(np.add.reduceat(w.hash * _powers(int(size.max()), p)[at], first) + np.uint64(k + 2)) for k, p in enumerate(_PRIMES))
            lead = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
            base = lead[bounds[w.doc[first]]]
            start, end = lead[w.start[first]] - base, lead[w.end[first + size - 1]] - base
            a, a1, a2 = anchors(w)
            word = np.concatenate([first, a])
            doc, d1, d2 = w.doc[word], np.concatenate([d1, a1]), (np.concatenate([d2, a2]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            n = np.concatenate([size, np.zeros(len(a), np.int64)])
            none = np.arange(len(word)) >= len(first)
            offsets = [pa.array(np.concatenate([x, np.zeros(len(a), np.int64)]).astype(np.int32), mask=none) for x in (start, end)]
            cols = [ids[doc], (word - head[doc]).astype(np.int32), n.astype(np.int32), d1.view(np.int64), d2]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), *offsets, pa.array(_repeats(doc, d1, d2))], names=[c.split()[0] for c in _ANCHORS.split(", ")])


def _end_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each asked window, by its first word or else by its digest: the words and offsets around it."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
    for batch in batches:
        for part in slices(batch, "text"):
            text = part.column(1)
            w = words(text, chars=True)
            _, bounds = text_bytes(text)
            lead = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
            head = np.searchsorted(w.doc, np.arange(len(text) + 1))
            value = w.hash.view(np.int64)
            rows: list[tuple] = []
            for k, (doc, asked) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)):
                low, high, base = int(head[k]), int(head[k + 1]), lead[bounds[k]]
                _, d1 = windows(w.hash[low:high], w.doc[low:high], ANCHOR)
                order = np.argsort(d1, kind="stable")
                places = np.searchsorted(d1[order], np.array([x["d1"] for x in asked], np.int64).view(np.uint64))
                for x, place in zip(asked, places.tolist(), strict=True):
                    at = x["at"] if x["at"] >= 0 else int(order[place]) if place < len(order) else len(d1)
                    if at >= len(d1) or int(d1[at]) != x["d1"] % 2**64:
                        continue  # another text under the same id has it
                    at += low
                    a, b = max(low, at - ANCHOR + 1), min(high, at + 2 * ANCHOR - 1)
                    rows.append((doc, x["d1"], x["at"], at - low, value[a:at][::-1], value[at + ANCHOR : b], lead[w.start[a : at + 1]][::-1] - base, lead[w.end[at + ANCHOR - 1 : b]] - base))
            cols = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=[c.split()[0] for c in _ENDS.split(", ")])


def _joined(spans: DataFrame) -> DataFrame:
    """Spans (doc_id, first, behind, start, end, kept_doc_id; words and code points) that overlap or touch, as one."""
    order = Window.partitionBy("doc_id").orderBy("first", "behind")
    reach = F.max("behind").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("new", (F.coalesce(reach, F.lit(-1)) < F.col("first")).cast("int")).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), (F.max("behind") - F.min("first")).alias("n_words"), F.min_by("kept_doc_id", F.struct("first", "behind")).alias("kept_doc_id")
    ).drop("run")


def repeated_passages(docs: DataFrame, least_line: int = LEAST_LINE) -> DataFrame:
    """doc_id, start, end, n_words, kept_doc_id, as repeated_spans, of repeated lines of least_line words or more and
    repeated runs of LEAST_WORDS words or more.

    Windows are grouped globally; runs of repeated ones are extended word by word, by the texts of the document and
    of the one that keeps the window, which are read for the ends of runs only.
    """
    base = texts(docs).where("doc_id is not null")
    rows = materialize(base.mapInArrow(_anchor_rows, _ANCHORS).where((F.col("n") == 0) | (F.col("n") >= least_line)), "anchors")
    extra = _later(rows).select("doc_id", "at", "n", "d1", "start", "end", "kept_doc_id")
    line = extra.where(F.col("n") >= least_line).select("doc_id", F.col("at").alias("first"), (F.col("at") + F.col("n")).alias("behind"), "start", "end", "kept_doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy("at")
    marked = extra.where("n = 0").withColumn("new", (F.col("at") - F.coalesce(F.lag("at").over(order), F.lit(-ANCHOR - 1)) > ANCHOR).cast("int")).withColumn("run", F.sum("new").over(order))
    ends = F.struct("at", "d1", "kept_doc_id")
    runs = materialize(marked.groupBy("doc_id", "run").agg(F.min(ends).alias("a"), F.max(ends).alias("z")), "passage-runs")
    asked = [runs.select(F.col(f"{k}.kept_doc_id").alias("doc_id"), F.col(f"{k}.d1").alias("d1"), F.lit(-1).alias("at")) for k in "az"]
    asked += [runs.select("doc_id", f"{k}.d1", f"{k}.at") for k in "az"]
    asked = asked[0].unionByName(asked[1]).unionByName(asked[2]).unionByName(asked[3]).distinct()
    asked = asked.groupBy("doc_id").agg(F.collect_list(F.struct("d1", "at")).alias("asked"))
    around = materialize(base.join(asked, "doc_id").select("doc_id", "text", "asked").mapInArrow(_end_rows, _ENDS).dropDuplicates(["doc_id", "d1", "at"]), "passage-ends")
    out = runs
    for k, words_of, offsets in (("a", "before", "starts"), ("z", "behind", "ends")):
        theirs = around.where("at < 0").select(F.col("doc_id").alias(f"{k}_kept"), F.col("d1").alias(f"{k}_d1"), F.col(words_of).alias("there"))
        ours = around.where("at >= 0").select("doc_id", F.col("at").alias(f"{k}_at"), F.col(words_of).alias("here"), F.col(offsets).alias("offsets"))
        out = out.withColumns({f"{k}_kept": F.col(f"{k}.kept_doc_id"), f"{k}_d1": F.col(f"{k}.d1"), f"{k}_at": F.col(f"{k}.at")})
        # a passage that very many documents share ends alike in all of them
        ends_alike = out.groupBy(f"{k}_kept", f"{k}_d1").agg(F.count("*").alias("alike"))
        theirs = materialize(theirs.join(ends_alike, [f"{k}_kept", f"{k}_d1"]), "passage-theirs")
        out = join_counted(out, theirs, [f"{k}_kept", f"{k}_d1"], "alike").join(ours, ["doc_id", f"{k}_at"])
        same = F.array_append(F.zip_with("here", "there", lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
        more = (F.array_position(same, False) - 1).cast("int")
        out = out.withColumn(f"{k}_more", more).withColumn(f"{k}_offset", F.element_at("offsets", F.col(f"{k}_more") + 1)).drop("here", "there", "offsets")
        out = materialize(out, "passage-ended")
    passages = out.select("doc_id", (F.col("a_at") - F.col("a_more")).alias("first"), (F.col("z_at") + ANCHOR + F.col("z_more")).alias("behind"), F.col("a_offset").alias("start"), F.col("z_offset").alias("end"), F.col("a_kept").alias("kept_doc_id"))
    return _joined(line.unionByName(passages.where(F.col("behind") - F.col("first") >= LEAST_WORDS))).select("doc_id", "start", "end", "n_words", "kept_doc_id")


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """docs with the spans cut out of their texts; documents without spans pass as they are."""
    import pandas as pd

    cuts = spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("__cuts"))

    def cut(text, cuts):
        out = []
        for t, c in zip(text, cuts, strict=True):
            if t is not None and c is not None and len(c):
                parts, at = [], 0
                for s in c:
                    parts.append(t[at : s["start"]])
                    at = s["end"]
                t = "".join([*parts, t[at:]])
            out.append(t)
        return pd.Series(out, dtype=object)

    cut.__annotations__ = {"text": pd.Series, "cuts": pd.Series, "return": pd.Series}
    return docs.join(cuts, "doc_id", "left").withColumn("text", F.pandas_udf(cut, "string")("text", "__cuts")).select(*docs.columns)
