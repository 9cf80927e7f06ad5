"""The operators of this package over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerlake.llm import counterparts, covertree, lexical, mixing, packing, passages, pii, quality, repeats, search, secrets, simhash, vafile, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), length=2048)


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256)


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_duplicate_passages(table(spark, sf_dir, "documents"), words=50, width=5, similarity=0.8)


def op6_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.threshold_links(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op7_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"), length=200)


def op8_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages")).drop("url")


def op9_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)


def op10_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, F.array("source")).select("doc_id", "size", "source_size", "target", "taken")


def op11_aho_corasick_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, width=64, scale=64, seed=1).drop("fetched")


def op13_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


SQL = {
    "op4_maxscore_search": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op6_cover_tree": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a), c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)""",
    "op8_warc_segments": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
        FROM f""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_best_fit_packing, op2_pii_weak_supervision, op3_crf_quality, op4_maxscore_search, op5_compact_windows, op6_cover_tree, op7_bwt_repeats, op8_warc_segments, op9_simhash_bktree, op10_flow_mixing, op11_aho_corasick_search, op12_va_file_clusters, op13_entropy_secrets)}


def oracle_sql() -> dict[str, str]:
    return SQL | counterparts.SQL
