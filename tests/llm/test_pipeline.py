import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from glasslake.llm import simhash

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" in a plain sentence of words.", "en", "s", 70)], docs.schema)
    at = docs.unionByName(odd)
    before = {r.doc_id for r in at.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SF)
        assert out.columns == docs.columns
        at = corpus_pipeline.materialize(out, "t")
        kept = {r.doc_id for r in at.collect()}
        assert kept <= before
        before = kept
    assert len(kept) > 0.6 * docs.count()
    assert at.where(F.col("text").rlike("[0-9a-f]{40}")).isEmpty()
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept


def test_stages_on_edge_rows(spark):
    """Nulls anywhere, empty and long texts, repeated rows, rows without an id, clashing columns, and an empty table."""
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one"), (4, "one"), (5, "word " * 60_000), (None, "no id"), (None, None), (6, "x" * 200_000), (7, "token = 04dbebab91ab85687d33eeaaf9ac699e1188f962"), (8, "Ünïcödé 日本語 😀")]
    plain = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs = plain.withColumns({c: F.lit("x") for c in ("key", "rep", "digest", "component_id", "score", "y", "spans", "item_id", "ids", "topic", "place", "start", "length")})
    want = {"quality": None, "near_duplicates": 9, "decontamination": 11, "secrets": 11}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        got = out.collect()
        assert out.columns == docs.columns and len(got) <= len(rows)
        assert want[name] is None or len(got) == want[name], name
        assert stage(spark, docs.limit(0), SF).count() == 0
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert len({(r.doc_id, r.start) for r in pieces if r.doc_id == 4}) == 1 and sum(r.doc_id == 4 for r in pieces) == 2
    assert sum(r.length for r in pieces if r.doc_id == 5) == next(r.doc_tokens for r in pieces if r.doc_id == 5) == 60_001
    assert corpus_pipeline.packing(spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("tile", [None, (2, 3, 1 << 20), (64, 256, 1)])
def test_near_duplicates_against_brute_force(spark, tile, monkeypatch):
    """The rows that stay are the smallest of each group that all pairs of shingle sets connect, however small the tiles are."""
    if tile is not None:
        for name, n in zip(("TILE_FAR", "TILE_ALL", "TILE_BYTES"), tile, strict=True):
            monkeypatch.setattr(simhash, name, n)
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def shingles(text):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    label = {d: d for d in sets}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if label[a] != label[b] and (x == y or len(x & y) >= 0.8 * len(x | y) > 0):
                low, high = sorted((label[a], label[b]))
                label = {d: low if v == high else v for d, v in label.items()}
    want = {d for d in ids if label[d] == d}
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert len(want) < len(ids) and got == want


def test_whole_run(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns) and pieces.count() > 0


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
