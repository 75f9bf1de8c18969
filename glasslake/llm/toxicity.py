"""Toxicity by weak supervision.

1. Voters. A written lexicon per language; each entry of a mined lexicon (words, and beginnings of which a text holds
   one or several different words); how many different entries a text holds, how densely, and that it holds none.
   Entries are mined by contrast between the training rows, because the languages of a corpus are not known here;
   beyond proposing them, labels are neither a voter nor the model's start.
2. A generative label model (expectation maximisation from the voters' majority) estimates from the votes alone how
   each voter votes in each class and how voters correlate within a class; correlated voters share their weight.
3. A linear classifier over the entries and counts is trained on the model's posterior labels; labels of the training
   rows give the class balance and place the scale: the cut between the classes lies at CUT.

Fitted on the driver from bounded, documented samples of the training rows; scoring runs in the executors over whole
texts. Labels, language, source and id are never inputs of a score.

Defined results: null and empty texts get the score of a text without hits; null labels are ignored; a document with
several rows takes part once, with its least text; repeated rows are scored alike; without training labels of both
classes every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import crc_bucket, materialize, slices

#: Bounds of the training sample per class, of the candidates that reach the driver, and of the entries kept.
MAX_TOXIC, MAX_HARMLESS, MAX_CANDIDATES, MAX_ENTRIES = 4000, 8000, 6000, 400
#: Lengths of beginnings.
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: An entry needs a log-likelihood ratio that chance does not reach among millions of words, and so high a rate in
#: toxic documents against harmless ones.
LEAST_EVIDENCE, LEAST_LIFT = 24.0, 6.0
#: The score at the cut between the classes, and what a missed toxic text counts there.
CUT, MISS = 0.7, 3
#: Insults by language, as small letters.
LEXICON = {
    "en": "idiot idiots moron morons stupid imbecile scum trash garbage loser losers clown pathetic worthless disgusting dumb fool filth vermin parasite bastard jerk".split(),
    "de": "idiot idioten trottel dumm dummkopf abschaum müll versager clown erbärmlich wertlos widerlich ekelhaft arschloch dreckskerl vollidiot".split(),
    "fr": "idiot idiote imbécile crétin débile stupide ordure déchet raté clown pathétique dégoûtant salaud connard minable".split(),
    "es": "idiota imbécil estúpido estúpida escoria basura perdedor payaso patético inútil asqueroso tonto cretino cabrón".split(),
}
SIGNS = ".,;:!?|\"'()[]{}<>#%&*$-_"
KEPT_WORDS, KEPT_COUNTS = 150_000, 300_000
LEAST_HITS = (1, 2, 3, 5)
DENSE = (0.01, 0.03)


def plain_words(text: str) -> set[str]:
    """Different words of three letters or more, small, without signs around them."""
    return {w for x in set(text.lower().split()) if len(w := x.strip(SIGNS)) >= 3 and w[0].isalpha()}


def _candidates(text: str) -> set[str]:
    """Entries that the text supports: "w:" words; "1:" and "2:" beginnings with one or two different words."""
    words = plain_words(text)
    seen = Counter(w[:n] for w in words for n in BEGINNINGS if len(w) >= n)
    return {f"w:{w}" for w in words} | {f"1:{b}" for b in seen} | {f"2:{b}" for b, n in seen.items() if n >= 2}


def mine(sample: DataFrame) -> list[str]:
    """Entries that mark toxic rows, strongest first, one per group of beginnings and longer forms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {0: Counter(), 1: Counter()}

        def rows() -> pa.RecordBatch:
            names = sorted(set(tallies[0]) | set(tallies[1]))
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([tallies[k][n] for n in names], pa.int64()) for k in (1, 0))], names=["entry", "toxic", "harmless"])

        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist(), strict=True):
                tallies[y].update(_candidates(text))
                if len(tallies[0]) + len(tallies[1]) > KEPT_COUNTS:  # partial counts go on, the grouping adds them up
                    yield rows()
                    tallies = {0: Counter(), 1: Counter()}
        yield rows()

    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return []
    ratio = F.lit(n[0] / n[1])
    totals = sample.mapInArrow(count, "entry string, toxic long, harmless long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("harmless").alias("harmless"))
    part = lambda seen, of: F.col(seen) * F.log(F.greatest(F.col(seen), F.lit(1)) * (n[0] + n[1]) / (n[of] * (F.col("toxic") + F.col("harmless"))))
    evidence = 2 * (part("toxic", 1) + part("harmless", 0))
    strong = totals.withColumn("evidence", evidence).where(F.col("evidence") >= LEAST_EVIDENCE).where(F.col("toxic") * ratio >= LEAST_LIFT * (F.col("harmless") + 0.5))
    kept: list[str] = []
    # of entries with about the same evidence the longest, most special one comes first; a beginning that one word
    # proves comes before the same beginning with two, which misses texts with a single word of it
    kind = F.when(F.col("entry").startswith("2:"), 1).otherwise(0)
    for r in strong.orderBy(F.desc(F.round(F.log2("evidence") * 8)), F.desc(F.length("entry")), kind, F.desc("entry")).limit(MAX_CANDIDATES).collect():
        stem = r.entry[2:]
        if len(kept) < MAX_ENTRIES and not any(stem.startswith(k[2:]) or k[2:].startswith(stem) for k in kept):
            kept.append(r.entry)
    return kept


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class LabelModel:
    """P(toxic | votes) from voters of unknown accuracy: votes are -1, 0 (silent, no evidence) or 1."""

    def __init__(self, votes: np.ndarray, prior: float, rounds: int = 50) -> None:
        n, m = votes.shape
        # the voters' majority starts the model; the class balance is given, as most voters only ever vote one way, and
        # is held in every round: else correlated voters, counting less and less, bring all posteriors down to it
        q = np.where(votes.sum(axis=1) > 0, 0.95, 0.02)
        self.weight, self.prior, self.shift = np.ones(m), float(np.clip(prior, 0.01, 0.99)), 0.0
        for _ in range(rounds):
            self.tables = np.stack([np.stack([((votes == v) * w[:, None]).sum(axis=0) + 0.5 for v in (-1, 0, 1)]) for w in (1 - q, q)])
            self.tables /= self.tables.sum(axis=1, keepdims=True)
            # residual correlation within the classes: voters that vote alike count less, voters of other texts do not
            expected = np.stack([(self.tables[k] * np.array([-1, 0, 1])[:, None]).sum(axis=0) for k in (0, 1)])
            rest = votes - (expected[0][None, :] * (1 - q)[:, None] + expected[1][None, :] * q[:, None])
            scale = np.sqrt((rest**2).mean(axis=0)) + 1e-6
            self.correlation = np.maximum((rest / scale).T @ (rest / scale) / n, 0)
            np.fill_diagonal(self.correlation, 0)
            self.weight = 1 / (1 + self.correlation.sum(axis=1))
            self.shift = self._balance(self._evidence(votes))
            new = self.posterior(votes)
            done = np.abs(new - q).max() < 1e-4
            q = new
            if done:
                break

    @property
    def accuracy(self) -> np.ndarray:
        """How often each voter is right when it votes."""
        right = self.prior * self.tables[1][2] + (1 - self.prior) * self.tables[0][0]
        wrong = self.prior * self.tables[1][0] + (1 - self.prior) * self.tables[0][2]
        return right / (right + wrong)

    def _evidence(self, votes: np.ndarray) -> np.ndarray:
        ratio = np.log(self.tables[1]) - np.log(self.tables[0])
        ratio[1] = 0
        return (ratio[votes + 1, np.arange(votes.shape[1])] * self.weight).sum(axis=1)

    def _balance(self, evidence: np.ndarray) -> float:
        """The shift at which the posteriors' mean is the class balance."""
        low, high = -60.0, 60.0
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (low, mid) if _sigmoid(evidence + mid).mean() > self.prior else (mid, high)
        return (low + high) / 2

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _sigmoid(self._evidence(votes) + self.shift)


class Lexicon:
    """The mined entries and the written lexicons; hits of a text are counts of different words per entry."""

    def __init__(self, entries: list[str]) -> None:
        self.entries = entries
        self.words = {e[2:]: k for k, e in enumerate(entries) if e[0] == "w"}
        self.stems = {e[2:]: k for k, e in enumerate(entries) if e[0] != "w"}
        self.twice = np.array([e[0] == "2" for e in entries], bool)
        self.languages = sorted(LEXICON)
        self.written = {w: tuple(i for i, lang in enumerate(self.languages) if w in LEXICON[lang]) for lang in self.languages for w in LEXICON[lang]}

    def of_word(self, word: str) -> tuple[int, ...]:
        """Numbers of the entries that a word belongs to; written lexicons are numbered behind the entries."""
        found = [k for n in BEGINNINGS if len(word) >= n and (k := self.stems.get(word[:n])) is not None]
        if word in self.words:
            found.append(self.words[word])
        return (*found, *(len(self.entries) + i for i in self.written.get(word, ())))

    def features(self, words: list[set[str]], known: dict[str, tuple[int, ...]]) -> np.ndarray:
        """Columns: per entry whether it is met, written lexicons, numbers of hits reached, density reached, none."""
        m = len(self.entries)
        wide = m + len(self.languages)
        out = np.zeros((len(words), wide + len(LEAST_HITS) + len(DENSE) + 1), np.float32)
        for i, own in enumerate(words):
            if len(known) > KEPT_WORDS:
                known.clear()
            seen: Counter = Counter()
            of: list[tuple[int, ...]] = []
            for w in own:
                ks = known.get(w)
                if ks is None:
                    ks = known[w] = self.of_word(w)
                if ks:
                    seen.update(ks)
                    of.append(ks)
            met = {k for k, n in seen.items() if k >= m or n >= 1 + self.twice[k]}
            if met:
                out[i, list(met)] = 1
            hits = sum(not met.isdisjoint(ks) for ks in of)  # a lone word of an entry that needs two is no hit
            out[i, wide : wide + len(LEAST_HITS)] = [hits >= n for n in LEAST_HITS]
            out[i, wide + len(LEAST_HITS) : -1] = [hits >= 2 and hits >= d * len(own) for d in DENSE]
            out[i, -1] = not hits
        return out

    def votes(self, features: np.ndarray) -> np.ndarray:
        """1 for what is met, else silent; no hit at all speaks against."""
        out = features.astype(np.int64)
        out[:, -1] *= -1
        return out


@dataclass
class ToxicModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float
    label_model: LabelModel

    def score(self, words: list[set[str]], known: dict[str, tuple[int, ...]]) -> np.ndarray:
        logit = self.lexicon.features(words, known) @ self.weights + self.bias
        return _sigmoid(logit.astype(float))


def _logistic(x: np.ndarray, target: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    w, b, m, v = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
    for step in range(1, steps + 1):
        d = (_sigmoid(x @ w + b) - target) / len(x)
        g = np.append(x.T @ d + 1e-4 * w, d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The middle of the gap in z that separates y best; a missed toxic text counts as MISS clean ones that are marked."""
    order = np.argsort(-z, kind="stable")
    caught = np.cumsum(y[order])
    f = (1 + MISS) * caught / (np.arange(1, len(z) + 1) + MISS * y.sum())
    ends = np.append(z[order][1:] < z[order][:-1], True)  # a cut lies between different values
    k = int(np.argmax(np.where(ends, f, -1)))
    return float(z[order][k] + (z[order][k + 1] if k + 1 < len(z) else z[order][k] - 2)) / 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> ToxicModel | None:
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(crc_bucket("doc_id", modulus) != held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("y = 1").orderBy(*order).limit(MAX_TOXIC).unionByName(known.where("y = 0").orderBy(*order).limit(MAX_HARMLESS))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    # copies would make every word of theirs look like evidence: one document (the first) per pair of least long-word hashes
    long_words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[^\s]{7,}"), F.lit(0)))
    least = F.slice(F.array_sort(F.transform(long_words, lambda w: F.xxhash64(w))), 1, 2)
    sample = sample.withColumn("least", least).withColumn("least", F.when(F.size("least") < 2, F.array(F.xxhash64("text"))).otherwise(F.col("least")))
    sample = materialize(sample.groupBy("y", "least").agg(F.min(F.struct("doc_id", "text")).alias("first")).select("first.doc_id", "y", "first.text"), "toxicity-sample")
    entries = mine(sample)
    if not entries:
        return None
    lexicon = Lexicon(entries)

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        for part in (p for batch in batches for p in slices(batch, "text")):
            x = lexicon.features([plain_words(t) for t in part.column("text").to_pylist()], known)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.array([np.flatnonzero(r) for r in x], pa.list_(pa.int32()))], names=["doc_id", "y", "on"])

    rows = sample.mapInArrow(hit, "doc_id long, y int, on array<int>").toArrow().sort_by("doc_id")
    x = np.zeros((len(rows), lexicon.features([set()], {}).shape[1]), np.float32)
    for i, on in enumerate(rows.column("on").to_pylist()):
        x[i, on] = 1
    votes = lexicon.votes(x)
    y = rows.column("y").to_numpy()
    model = LabelModel(votes, y.mean())
    w, b = _logistic(x.astype(float), model.posterior(votes))
    cut = best_cut(x @ w + b, y)
    return ToxicModel(lexicon, w, b - cut + np.log(CUT / (1 - CUT)), model)


def score_toxicity(docs: DataFrame, model: ToxicModel | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with one more column: the score of every whole text."""
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))
    import pandas as pd

    def score(column):
        known: dict[str, tuple[int, ...]] = {}
        for series in column:
            yield pd.Series(np.concatenate([np.empty(0), *(model.score([plain_words(t)], known) for t in series)]), dtype=float)

    score.__annotations__ = {"column": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(score_col, F.pandas_udf(score, "double")(F.coalesce(F.col(text_col), F.lit(""))))
