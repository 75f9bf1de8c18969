"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages and only the document is labelled. Every passage is encoded (hashed word shapes and
a few ratios, then a dense layer), gated attention learns how much each passage counts, and the weighted passage
representation is scored.

The model is fitted on the driver from a bounded, documented sample of labelled rows; scoring runs over every whole
text in the executors. Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts are one empty passage and get a score; null labels are ignored; repeated rows
are scored alike; a table without usable labels gives the score 1.0 (nothing is rejected).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import crc_bucket, slices

#: Words of a passage, hashed shape features, further ratios, hidden size.
PASSAGE_WORDS, SHAPES, RATIOS, HIDDEN = 64, 64, 8, 24
#: Bounds of the training sample: labelled documents, the first by a hash of their id, and passages of each, evenly
#: spread over its text (so the bound takes effect from 7,680 words on, and the driver gets 104 MB at most). Scores always
#: see all passages.
MAX_TRAIN_DOCS, MAX_TRAIN_PASSAGES = 3000, 120
KEPT_WORDS = 150_000

_shape_of: dict[str, tuple[int, int]] = {}


def _shape(word: str) -> tuple[int, int]:
    """Hashed shape (runs of capitals, small letters, digits; other signs as they are) and a coarse length."""
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word[:24]]
    runs = "".join(k for i, k in enumerate(kinds) if not i or kinds[i - 1] != k or k not in "Aa9")
    return zlib.crc32(runs.encode("utf-8", "surrogatepass")) % SHAPES, min(len(word), 40)


def passage_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(passages, SHAPES + RATIOS) and the number of passages of each text, at least one."""
    known = _shape_of
    if len(known) > KEPT_WORDS:
        known.clear()
    split = [t.split() for t in texts]
    words = [w for s in split for w in s]
    for w in set(words).difference(known):
        known[w] = _shape(w)
    counts = np.fromiter(map(len, split), np.int64, len(split))
    per_text = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first_word = np.cumsum(counts) - counts
    first_passage = np.cumsum(per_text) - per_text
    total = int(per_text.sum())
    out = np.zeros((total, SHAPES + RATIOS), np.float32)
    if words:
        pairs = np.array([known[w] for w in words], np.int64)
        doc = np.repeat(np.arange(len(texts)), counts)
        passage = first_passage[doc] + (np.arange(len(words)) - first_word[doc]) // PASSAGE_WORDS
        n = np.bincount(passage, minlength=total).astype(np.float32)
        hist = np.bincount(passage * SHAPES + pairs[:, 0], minlength=total * SHAPES).reshape(total, SHAPES)
        out[:, :SHAPES] = np.sqrt(hist / np.maximum(n, 1)[:, None])
        length = np.bincount(passage, weights=pairs[:, 1], minlength=total) / np.maximum(n, 1)
        ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
        code = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        unique = np.unique(passage * (len(ids) + 1) + code)
        distinct = np.bincount(unique // (len(ids) + 1), minlength=total) / np.maximum(n, 1)
        again = np.zeros(len(words))
        again[1:] = (code[1:] == code[:-1]) & (passage[1:] == passage[:-1])
        repeated = np.bincount(passage, weights=again, minlength=total) / np.maximum(n, 1)
        short = np.bincount(passage, weights=pairs[:, 1] <= 1, minlength=total) / np.maximum(n, 1)
        out[:, SHAPES] = np.log1p(n) / 5
        out[:, SHAPES + 1] = length / 10
        out[:, SHAPES + 2] = distinct * (n > 8) + (n <= 8)
        out[:, SHAPES + 3] = repeated * 3
        out[:, SHAPES + 4] = short
        out[:, SHAPES + 5] = n < PASSAGE_WORDS
        out[:, SHAPES + 6] = (distinct < 0.5) & (n > 8)
    out[:, SHAPES + 7] = out[:, SHAPES] == 0
    return out, per_text


def _segments(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)


class GatedAttention:
    """score = sigmoid(c . sum_k a_k h_k + c0), a = softmax(w . (tanh(V h) * sigmoid(U h))), h = tanh(W x + b)."""

    def __init__(self, width: int, hidden: int = HIDDEN, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": draw(width, hidden), "b": np.zeros(hidden), "V": draw(hidden, hidden), "U": draw(hidden, hidden), "w": draw(hidden), "c": draw(hidden), "c0": np.zeros(1)}

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
        p, (first, seg) = self.p, _segments(sizes)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, first)[seg])
        a /= np.add.reduceat(a, first)[seg]
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["c0"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "y": y, "first": first, "seg": seg}

    def gradient(self, f: dict, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p, seg, first = self.p, f["seg"], f["first"]
        dy = (f["y"] - labels) * weight / weight.sum()
        dz = dy[:, None] * p["c"]
        da = (f["h"] * dz[seg]).sum(axis=1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[seg])
        dg = de[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz[seg] + dt @ p["V"].T + ds @ p["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dpre, "b": dpre.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "c0": dy.sum(keepdims=True)}

    def fit(self, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 40, batch: int = 128, rate: float = 0.01) -> GatedAttention:
        rng = np.random.default_rng(11)
        first, _ = _segments(sizes)
        share = max(labels.mean(), 1e-3), max(1 - labels.mean(), 1e-3)
        weight = np.where(labels > 0, 0.5 / share[0], 0.5 / share[1])
        m, v, step = {k: 0 * q for k, q in self.p.items()}, {k: 0 * q for k, q in self.p.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(sizes))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                rows = np.concatenate([np.arange(first[k], first[k] + sizes[k]) for k in own])
                g = self.gradient(self.forward(x[rows], sizes[own]), labels[own], weight[own])
                step += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    self.p[k] = self.p[k] - rate * (0.5 ** (epoch / 15)) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, max_docs: int = MAX_TRAIN_DOCS) -> GatedAttention | None:
    """Fit on at most max_docs labelled documents whose crc32(doc_id) mod modulus is not held_out; None without labels."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(crc_bucket("doc_id", modulus) != held_out)
    sample = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, sizes = passage_features(part.column(2).to_pylist())
                if sizes.max(initial=0) > MAX_TRAIN_PASSAGES:
                    first, _ = _segments(sizes)
                    kept = [a + np.linspace(0, n - 1, min(n, MAX_TRAIN_PASSAGES)).astype(np.int64) for a, n in zip(first, sizes, strict=True)]
                    x, sizes = x[np.concatenate(kept)], np.minimum(sizes, MAX_TRAIN_PASSAGES)
                ends = np.append(0, np.cumsum(sizes) * x.shape[1]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))], names=["doc_id", "y", "x"])

    bags = rows.mapInArrow(encode, "doc_id long, y double, x array<float>").toArrow().sort_by("doc_id")
    y = bags.column("y").to_numpy()
    if not len(y) or y.min() == y.max():
        return None
    width = SHAPES + RATIOS
    flat = bags.column("x").combine_chunks()
    sizes = flat.value_lengths().to_numpy() // width
    return GatedAttention(width).fit(flat.flatten().to_numpy().reshape(-1, width).astype(np.float64), sizes, y)


def score_quality(docs: DataFrame, model: GatedAttention | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with one more column: the score of every whole text. All other columns pass unread."""
    if model is None:
        return docs.withColumn(score_col, F.lit(1.0))

    import pandas as pd

    def score(column):
        for series in column:
            out = [np.array([], float)]
            for at in range(0, len(series), 128):
                x, sizes = passage_features(series.iloc[at : at + 128].tolist())
                out.append(model.forward(x, sizes)["y"])
            yield pd.Series(np.concatenate(out))

    score.__annotations__ = {"column": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(score_col, F.pandas_udf(score, "double")(F.coalesce(F.col(text_col), F.lit(""))))
