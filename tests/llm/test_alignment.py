import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glasslake.llm import alignment

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    (None, "no id"), (1, None), (2, ""), (3, " "), (4, "one"), (4, "one"), (5, "  two  spaces "), (6, "<|endoftext|> and <s> and </s> <unk> ▁"), (7, "Ünïcödé 日本語 😀\x00\x1c\n\t"), (8, " " * 12_000 + "x"),
    (9, "▁under"), (10, "é ﬁ Å"), (11, "a" * 30_000), (12, "word " * 30_000),
]


@pytest.fixture(scope="module")
def library():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    vocab = {k: t for t, k in a.get_vocab().items()}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def tokens(text):
        if not text:
            return [], []
        left = [(k, bytes(byte_of[c] for c in vocab[k])) for k in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(text)]
        whole = (" " + text).encode()
        return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else ([], [])

    return tokens


def brute(rows, tokens):
    """Overlaps by comparing ranges, groups by cutting at shared ends."""
    found = []
    held = Counter()
    for doc_id, text in rows:
        sides = []
        for side in tokens(text):
            at, spans = 0, []
            for k, x in side:
                spans.append((k, at, at + len(x)))
                at += len(x)
            sides.append(spans)
        a, b = sides
        links, j = [], 0
        for k, low, high in a:
            while j and b[j - 1][2] > low:
                j -= 1
            while j < len(b) and b[j][1] < high:
                if b[j][2] > low:
                    links.append((k, b[j][0]))
                j += 1
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = defaultdict(lambda: ([], []))
        for n, side in enumerate(sides):
            g = 0
            for k, _, high in side:
                groups[g][n].append(str(k))
                g += high == ends[g]
        cut = ";".join(f"{','.join(groups[g][0])}|{','.join(groups[g][1])}" for g in range(len(ends)))
        held.update(set(links))
        found.append((doc_id, len(a), len(b), len(ends), links, hashlib.sha256(cut.encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (k, _), n in held.items():
        top[k] = max(top[k], n)
    return sorted(((d, n_a, n_b, g, len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), sha) for d, n_a, n_b, g, links, sha in found), key=str)


def run(df, **how):
    return sorted((tuple(r) for r in alignment.alignment_counts(df, A, B, **how).select(*COLUMNS).collect()), key=str)


def test_alignment_against_brute_force(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + ODD
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("slice", "bucket", "keys", "docs", "n_a", "pairs", "answers")})
    want = brute(rows, library)
    got = run(df)
    assert got == want
    assert sum(r[1] == 0 for r in got) >= 3 and sum(r[6] for r in got) > 0
    assert run(df.limit(0)) == []


def test_many_small_slices(spark, library):
    """A few documents a slice: the counts stay corpus-wide."""
    rows = [(k, ["the same text again", "the other text", "Text, again!", "the same text again"][k % 4] * (1 + k % 3)) for k in range(60)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), slice_bytes=100) == brute(rows, library)


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_tokens_of_any_text(library, column):
    both = alignment.two_tokenizers(A, B)
    left, right = both.encode(column)
    for t, a, b in zip(column, left, right, strict=True):
        want = library(t)
        assert a.tolist() == [k for k, _ in want[0]] and b.tolist() == [k for k, _ in want[1]]


def test_groups_as_text(spark, library):
    df = spark.createDataFrame([(1, "Unbelievable words"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in alignment.alignments(df, A, B).collect()}
    assert got[2] == "" and hashlib.sha256(got[1].encode()).hexdigest() == run(df)[0][7]
