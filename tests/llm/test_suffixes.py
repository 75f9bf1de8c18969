import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glasslake.llm import suffixes
from glasslake.llm.wordhash import text_bytes

SF = "/root/testdata/sf0.001"


def brute(rows, least):
    """Count every string of `least` bytes, then mark the bytes under those that occur twice."""
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(x[k : k + least] for _, x in data for k in range(len(x) - least + 1))
    out = []
    for d, x in data:
        gone = np.zeros(len(x) + 1, bool)
        for k in range(len(x) - least + 1):
            if seen[x[k : k + least]] > 1:
                gone[k : k + least] = True
        edge = np.flatnonzero(np.append(gone, False) != np.append(False, gone)).tolist()
        out.append((d, len(x), edge[::2], edge[1::2], bytes(b for b, g in zip(x, gone, strict=False) if not g)))
    return sorted(out, key=str)


def run(df, **how):
    return sorted(((r.doc_id, r.n_bytes, list(r.starts), list(r.ends), bytes(r.kept)) for r in suffixes.repeated_bytes(df, **how).collect()), key=str)


def made(seed, n):
    """Texts that share stretches of many lengths at many offsets, some just under and over 200 bytes, with runs and cycles."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdé ") for _ in range(k))
    shared = [word(rng.choice((150, 198, 199, 200, 201, 205, 260, 290, 291, 292, 330, 500, 900))) for _ in range(8)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            s = rng.choice(shared)
            a = rng.choice((0, 0, rng.randrange(60)))
            parts += [word(rng.randrange(120)), s[a : a + rng.choice((180, 200, 202, 240, 400, 1000))]]
        rows.append((k, "".join([*parts, word(rng.randrange(150))])))
    return [*rows, (n, "z" * 401), (n + 1, "xy" * 150), (n + 2, "q" * 200), (n + 3, rows[0][1]), (n + 4, "q" * 199)]


@pytest.mark.parametrize("slice_bytes", [1, 1500, 1 << 21])
def test_suffixes_against_counts(spark, slice_bytes):
    rows = made(slice_bytes, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert run(df, slice_bytes=slice_bytes) == brute(rows, 200)


@pytest.mark.parametrize("least", [8, 30, 64, 115])
def test_other_lengths(spark, least):
    rng = random.Random(least)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(90)))) for k in range(60)] + [(100 + k, "".join(rng.choice("abcdefgh") for _ in range(300)) * 2) for k in range(3)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), least=least, slice_bytes=700) == brute(rows, least)


def test_suffixes_of_odd_rows(spark):
    rows = [(None, "n" * 250), (1, None), (2, ""), (3, "é" * 150), (4, "x" + "é" * 99), (5, "word " * 60_000), (6, "Same text, " * 25), (6, "Same text, " * 25), (7, "日本語" * 40), (8, "😀")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("slice", "bucket", "keys", "state", "body", "bounds", "answers", "starts")})
    assert run(df) == brute(rows, 200)
    assert run(df.limit(0)) == [] and run(df.where("doc_id in (1, 2)")) == brute(rows[1:3], 200)


def test_suffixes_on_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows, 200) and any(r[2] for r in got)
    assert all(hashlib.sha256(r[4]).hexdigest() for r in got)


@given(st.lists(st.integers(0, 400), max_size=12))
@settings(max_examples=60, deadline=None)
def test_cover_places(sizes):
    bounds = np.append(0, np.cumsum(sizes)).astype(np.int64)
    for period in suffixes.COVERS:
        part = suffixes.Slice(np.zeros(int(bounds[-1]), np.uint8), bounds, 200, period)
        want = [a + k for a, b in zip(bounds[:-1], bounds[1:], strict=True) for k in range(b - a - (200 - period + 1) + 1) if k % period in suffixes.COVERS[period]]
        assert part.cover().tolist() == want
        assert {(a - b) % period for a in suffixes.COVERS[period] for b in suffixes.COVERS[period]} == set(range(period))


def test_digests_in_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    body = rng.integers(0, 256, 5000).astype(np.uint8)
    body[2000:2400] = body[100:500]
    places = np.arange(0, 4800, 3)
    whole = suffixes.digests(body, places, 200)
    monkeypatch.setattr(suffixes, "CHUNK", 64)
    suffixes._tables.cache_clear()
    assert (suffixes.digests(body, places, 200) == whole).all()
    suffixes._tables.cache_clear()
    a, b = suffixes.digests(body, np.array([120]), 200), suffixes.digests(body, np.array([2020]), 200)
    assert a == b and len(set(whole.tolist())) == len({body[p : p + 200].tobytes() for p in places})
    assert text_bytes(pa.array([], pa.string()))[1].tolist() == [0]
