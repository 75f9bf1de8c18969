"""Secret scan: fixed patterns, plus a token-efficiency test for random strings.

Base kinds are leftmost non-overlapping matches of fixed patterns. The method adds spans of kind `random`: a run of
key-like signs that a tiktoken vocabulary spends many tokens on (few characters per token), because a random string
has no common pieces. Known digests, UUIDs, numbers, paths and identifiers are excluded first.

Limits: runs under 16 signs, and letters of one case only, are not judged; runs of digits alone are numbers.

Defined results: null and empty texts have no spans; null ids keep their row; an empty table gives no rows; offsets are code points, end exclusive; texts of any length are
scanned whole; repeated rows give equal rows; other columns are ignored (scan) or kept (redact).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glasslake.llm.common import slices, texts

#: The base patterns and the least lengths of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
KINDS = ("assign", "access", "hex", "random")

#: A run is random at so few characters per token, if so long: with letters and digits, or of letters in mixed case only.
RANDOM_LEAST, RANDOM_RATIO, LETTERS_RATIO = 16, 2.2, 2.0
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=\-])[A-Za-z0-9+/_.=\-]{16,}")
_WORDS = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
#: Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
DIGESTS = (32, 40, 56, 64, 96, 128)
_ALL_HEX = re.compile(r"[0-9a-fA-F]+")
#: Identifiers: parts of letters with a number behind at most, joined by signs.
_NAMES = re.compile(r"[A-Za-z]*[0-9]{0,6}(?:[_.\-/=+][A-Za-z]*[0-9]{0,6})*")

_ENCODINGS: dict[str, object] = {}


def vocabulary(path: str):
    """The tiktoken encoding of a ranks file, loaded once per worker."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    if _WORDS.search(text):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    for run in _RUN.finditer(text):
        # a run holds every match of 16 letters or digits that touches it whole
        at, part = run.start(), run[0]
        spans += [(at + m.start(), at + m.end(), "hex") for m in HEX.finditer(part) if m.end() - m.start() >= HEX_LEAST]
        if "AKIA" in part:
            spans += [(at + m.start(), at + m.end(), "access") for m in ACCESS.finditer(part) if m.end() - m.start() >= ACCESS_LEAST]
    return spans


def is_random(run: str, encoding) -> bool:
    """Whether a run of key-like signs is spelled in few characters per token and is no known form."""
    body = run.strip("._-=/+")
    if len(body) < RANDOM_LEAST or not any(c.isalpha() for c in body):
        return False
    if not any(c.isdigit() for c in body):
        # names of several words change case at few places, random letters at every other one
        letters = "".join(c for c in body if c.isalpha())
        changes = sum(a.islower() != b.islower() for a, b in zip(letters, letters[1:], strict=False))
        return 4 * changes >= len(letters) and len(body) / len(encoding.encode_ordinary(body)) <= LETTERS_RATIO
    if _UUID.fullmatch(body) or (_ALL_HEX.fullmatch(body) and len(body) in DIGESTS) or _NAMES.fullmatch(body):
        return False
    return len(body) / len(encoding.encode_ordinary(body)) <= RANDOM_RATIO


def random_spans(text: str, encoding) -> list[tuple[int, int, str]]:
    spans = []
    for run in _RUN.finditer(text):
        body = run[0].strip("._-=/+")
        # "name=value" and "a/b" hold their parts; the whole run counts only without such a joint
        lead = run.start() + run[0].find(body) if body else 0
        at = 0
        for piece in re.split(r"[=.]", body):
            if is_random(piece, encoding):
                spans.append((lead + at, lead + at + len(piece), "random"))
            at += len(piece) + 1
    return spans


def all_spans(text: str, encoding) -> list[tuple[int, int, str]]:
    base = base_spans(text)
    extra = [s for s in random_spans(text, encoding) if not any(b[0] <= s[0] and s[1] <= b[1] for b in base)]
    return sorted(base + extra, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_secrets(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id and spans array<struct<kind, start, end>> of every row of documents(doc_id, text)."""
    schema = "doc_id long, spans array<struct<kind: string, start: int, end: int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(ranks)
        for part in (p for batch in batches for p in slices(batch, "text")):
            found = [[{"kind": k, "start": a, "end": b} for a, b, k in all_spans(t, encoding)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return texts(docs).mapInArrow(run, schema)


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per base kind, the sha256 of the base spans as text, and all spans as text."""
    word = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.array_join(F.transform(F.filter("spans", lambda s: s["kind"] != "random"), word), ",")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]], F.sha2(base, 256).alias("base_sha256"), F.array_join(F.transform("spans", word), ",").alias("spans"))


def redact(docs: DataFrame, ranks: str, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span, base or random, replaced in the text; n_chars follows where the table has it."""
    import pandas as pd

    def clean(column):
        encoding = vocabulary(ranks)
        for series in column:
            out = []
            for text in series:
                spans = all_spans(text, encoding) if text else []
                if spans:
                    parts, at = [], 0
                    for a, b, _ in sorted(spans):
                        if a >= at:
                            parts += [text[at:a], mark]
                        at = max(at, b)
                    text = "".join([*parts, text[at:]])
                out.append(text)
            yield pd.Series(out, dtype=object)

    clean.__annotations__ = {"column": Iterator[pd.Series], "return": Iterator[pd.Series]}
    done = docs.withColumn("text", F.pandas_udf(clean, "string")("text"))
    return done.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))) if "n_chars" in docs.columns else done
