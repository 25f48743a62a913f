"""The registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, decontam, fingerprints, html, licenses, neardup, packing, pii, quality, rollup, tokens, toxicity, whitening
from .common import new_path, table, written


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(table(spark, sf_dir, "pages"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), size=2048, separator=0)


def op3_adaptive_scan_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("expressions")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in under the word-level vocabulary and those of at most 16 tokens go out again; the rest come in under
    the byte-level vocabulary too, first with the counts at hand, which a revision then puts right.

    Each batch is committed twice, as after a retry; the second time changes nothing.
    """
    rows = written(rollup.counted(table(spark, sf_dir, "documents"), also={"new_tokens": tokens.byte_counts}), "counts")
    own = rollup.Rollup(spark, new_path(spark, "rollup"))
    long = rows.where("n_tokens > 16")
    batches = {
        "load": rollup.inserts(rows, "word_bpe_49k"),
        "short": rollup.deletes(rows.where("n_tokens <= 16"), "word_bpe_49k"),
        "copy": rollup.inserts(long, "byte_bpe_50k"),
        "recount": rollup.revisions(long, "byte_bpe_50k"),
    }
    for name, changes in [*batches.items(), *batches.items()]:
        own.commit(name, changes)
    return own.totals(list(batches))


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined("_base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2, similarity=0.8)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", F.expr("int(score >= 0.5)").alias("predicted"), "spans")


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=16, scale=64, shift=1_000_000)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.fingerprinted(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


QUERIES = {
    f.__name__: f
    for f in (op1_html_extraction, op3_adaptive_scan_ann, op6_token_rollups, op10_importance_resampling, op11_token_alignment, op12_embedding_whitening, op13_document_fingerprints, op2_best_fit_packing, op4_license_scan, op5_benchmark_decontamination, op7_pii_spans, op8_minhash_neardup, op9_toxicity_crf)
}
#: Trained models and the tokenizer have no SQL; those queries are tested against plain versions.
ORACLE_SQL = {
    "op8_minhash_neardup": r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS d, doc_id AS m FROM n UNION SELECT e.y, r.m FROM r JOIN e ON e.x = r.d)
SELECT n.doc_id, n.n AS n_shingles, min(r.m) AS component_id, n.doc_id = min(r.m) AS kept FROM n JOIN r ON r.d = n.doc_id GROUP BY 1, 2"""
}
