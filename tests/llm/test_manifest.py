import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from glasslake.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r, text):
    parts = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in parts))


def brute(rows, changed):
    """Trees as nested lists of digests; a proof by walking up."""

    def levels(digests):
        out = [digests]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
    trees = {g: levels([leaf_of(r, r["text"]) for r in groups[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, r in enumerate(groups[g]):
            text = r["text"]
            if text is not None and changed(r["doc_id"]):
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            now, proof = leaf_of(r, text), ""
            for tree, pos in ((trees[g], at), (top, k)):
                for level in tree[:-1]:
                    low = pos // 8 * 8
                    left, right = "".join(level[low:pos]), "".join(level[pos + 1 : low + 8])
                    proof, now, pos = proof + left + right, sha(left + now + right), pos // 8
            out.append((r["doc_id"], leaf_of(r, r["text"]), trees[g][-1][0], top[-1][0], sha(proof), now, now == top[-1][0]))
    return sorted(out, key=str)


def crc3(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def run(df):
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    entries = manifest.manifest(df, tampered=F.when(third, manifest.lower_ascii(F.col("text"))).otherwise(F.col("text")))
    return sorted((tuple(r) for r in manifest.proofs(entries).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64, 1], [65, 7, 130, 1], [2] * 12])
def test_manifest_against_nested_lists(spark, sizes):
    rows, at = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            at += 7
            rows.append((at, ["Big Letters", "small letters", None, "", "ÄÖ Z"][at % 5], f"l{g}" if g else None, "s" if at % 3 else None, at % 11 or None))
    df = spark.createDataFrame(rows, DOCS)
    got = run(df.withColumns({c: F.lit("x") for c in ("low", "n", "digest", "path", "part", "children", "bucket", "group")}))
    assert got == brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows], crc3)
    assert len({r[3] for r in got}) == 1


def test_manifest_of_odd_rows(spark):
    """Null ids, repeated rows, one id for two texts, an empty and a null lang, a long text, no rows."""
    rows = [(None, "a", "", "s", 1), (None, None, None, None, None), (3, "Same", "x", "s", 4), (3, "Same", "x", "s", 4), (3, "Other", "x", "s", 5), (4, "Word " * 50_000, "x", "s", None), (5, "é", "ü", "s", 1), (-1, "Minus", "x", "s", 5)]
    df = spark.createDataFrame(rows, DOCS)
    want = brute([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows], crc3)
    assert run(df) == want
    assert run(df.limit(0)) == []


def test_one_group_over_many_partitions(spark):
    """One lang holds nearly all rows: ranks come from range partitions, and every leaf verifies by its own path."""
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.when(F.col("id") % 500 == 0, "b").otherwise("a").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    out = manifest.proofs(manifest.manifest(df.repartition(13)))
    assert out.count() == 5000 and out.where("NOT verified").isEmpty() and out.select("root").distinct().count() == 1
    rows = [r.asDict() for r in df.collect()]
    got = sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)
    assert got == brute(rows, lambda d: False)
