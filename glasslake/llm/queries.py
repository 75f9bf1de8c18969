"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasslake.llm import alignment, binary, decontam, embeddings, manifest, packing, pii, quality, secrets, simhash, substrings, suffixes, toxicity
from glasslake.llm.common import crc_bucket, work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_collision_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/token-binary-{uuid.uuid4().hex}"
    binary.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), "byte", 0)
    return binary.read_tokens(spark, path)


def op3_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"), modulus=5, held_out=0)
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


def op5_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), modulus=3, held_out=1)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_token_efficiency_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return secrets.digest_columns(found)


def op7_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_template_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replacements(_table(spark, sf_dir, "documents"), key=spark.conf.get("glasslake.pii.key", "surrogate-key"))


def op11_cover_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.repeated_bytes(_table(spark, sf_dir, "documents"), least=200)
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    tampered = F.when(shuffled, manifest.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return manifest.proofs(manifest.manifest(_table(spark, sf_dir, "documents"), tampered=tampered))


QUERIES = {
    f.__name__: f
    for f in (
        op1_collision_projections, op2_token_binary, op3_quality_mil, op4_unit_dedup, op5_weak_toxicity, op6_token_efficiency_secrets,
        op7_bm25_packing, op8_simhash_variants, op9_template_decontam, op10_pii_surrogates, op11_cover_suffixes, op12_token_alignment, op13_merkle_manifest,
    )
}

#: Where plain SQL gives the same rows at the test sizes; the others are compared by brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op1_collision_projections": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x)))
              AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
        ),
        link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
        reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
        comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT e.vec_id, (SELECT count(*) FROM link l WHERE l.a = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
        FROM embeddings e JOIN comp c ON c.vec_id = e.vec_id
    """,
    "op13_merkle_manifest": """
        WITH RECURSIVE crc_table AS (
            SELECT list(list_reduce(list_prepend(i::UBIGINT, [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)
        ),
        doc AS (
            SELECT doc_id, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
                concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                text, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)), lambda a, b: xor(a >> 8, t[((xor(a, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 3 = 0 AS changed
            FROM documents, crc_table
        ),
        leaf AS (
            SELECT doc_id, g, pos, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                sha256(head || coalesce(strlen(text) || ':' || CASE WHEN changed THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS tampered
            FROM doc
        ),
        node(g, level, pos, digest, n) AS (
            SELECT g, 0, pos, leaf, count(*) OVER (PARTITION BY g) FROM leaf
            UNION ALL
            SELECT g, level + 1, p, d, count(*) OVER (PARTITION BY g)
            FROM (SELECT g, level, pos // 8 AS p, sha256(string_agg(digest, '' ORDER BY pos)) AS d FROM node WHERE n > 1 GROUP BY g, level, pos // 8)
        ),
        sub AS (SELECT g, digest AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS pos FROM node WHERE n = 1),
        high(level, pos, digest, n) AS (
            SELECT 0, pos, subroot, count(*) OVER () FROM sub
            UNION ALL
            SELECT level + 1, p, d, count(*) OVER () FROM (SELECT level, pos // 8 AS p, sha256(string_agg(digest, '' ORDER BY pos)) AS d FROM high WHERE n > 1 GROUP BY level, pos // 8)
        ),
        step AS (
            SELECT a.g, a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
            FROM node a JOIN node b ON a.g = b.g AND a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL
        ),
        top AS (
            SELECT a.level, a.pos, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
            FROM high a JOIN high b ON a.level = b.level AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY ALL
        ),
        low_walk(doc_id, g, level, pos, cur, proof) AS (
            SELECT doc_id, g, 0, pos, tampered, '' FROM leaf
            UNION ALL
            SELECT w.doc_id, w.g, w.level + 1, w.pos // 8, sha256(s.l || w.cur || s.r), w.proof || s.l || s.r FROM low_walk w JOIN step s ON s.g = w.g AND s.level = w.level AND s.pos = w.pos
        ),
        low_end AS (SELECT doc_id, g, arg_max(cur, level) AS cur, arg_max(proof, level) AS proof FROM low_walk GROUP BY doc_id, g),
        high_walk(doc_id, level, pos, cur, proof) AS (
            SELECT e.doc_id, 0, s.pos, e.cur, e.proof FROM low_end e JOIN sub s ON s.g = e.g
            UNION ALL
            SELECT w.doc_id, w.level + 1, w.pos // 8, sha256(s.l || w.cur || s.r), w.proof || s.l || s.r FROM high_walk w JOIN top s ON s.level = w.level AND s.pos = w.pos
        ),
        done AS (SELECT doc_id, arg_max(cur, level) AS folded_root, sha256(arg_max(proof, level)) AS proof_sha256 FROM high_walk GROUP BY doc_id)
        SELECT l.doc_id, l.leaf, s.subroot, h.digest AS root, d.proof_sha256, d.folded_root, d.folded_root = h.digest AS verified
        FROM leaf l JOIN sub s ON s.g = l.g JOIN done d ON d.doc_id = l.doc_id CROSS JOIN (SELECT digest FROM high WHERE n = 1) h
    """,
}
