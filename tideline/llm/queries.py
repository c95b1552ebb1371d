"""The registered queries op1 .. op13, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_dir
from .alignment import align_tokenizers
from .chunk_dedup import repeated_passages
from .exact_dedup import exact_dedup
from .kneser_ney import score_quality
from .mixing import mix_sources
from .packing import pack_documents
from .pii import find_personal_data
from .pivot_search import top_k
from .rtree_search import hard_negatives
from .simhash import simhash_components
from .token_counts import token_counts
from .token_store import fetch, write_store
from .url_filter import LIST_WORDS, LOWER, RULES, UPPER, filter_urls, listed_hosts


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents")).drop("file", "row")


def op2(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op3(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"))


def op4(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_components(table(spark, sf, "documents"))


def op5(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(table(spark, sf, "documents"))


def op6(spark: SparkSession, sf: str) -> DataFrame:
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(table(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


def op8(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return filter_urls(pages, listed_hosts(pages))


def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs, path = table(spark, sf, "documents"), new_dir(spark, "store")
    write_store(docs, path, vocabulary("byte_bpe_50k.json"), end_id=2, vocabulary_size=50257)
    return fetch(spark, path, docs, vocabulary_size=50257).drop("ids")


def op10(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


def op11(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings").withColumn("label", moved), F.pmod("vec_id", F.lit(100)) == 0)


def op12(spark: SparkSession, sf: str) -> DataFrame:
    return find_personal_data(table(spark, sf, "documents"))


def op13(spark: SparkSession, sf: str) -> DataFrame:
    return align_tokenizers(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES = {
    "op1_exact_dedup": op1, "op2_exact_top_k": op2, "op3_source_mix": op3, "op4_simhash": op4,
    "op5_substring_dedup": op5, "op6_quality": op6, "op7_token_counts": op7, "op8_url_filter": op8,
    "op9_token_store": op9, "op10_packing": op10, "op11_hard_negatives": op11, "op12_personal_data": op12,
    "op13_tokenizer_alignment": op13,
}

FITS = [
    (f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, verdict)
    for h, p, verdict in sorted(RULES, key=lambda r: -len(r[0] + r[1]))]
ANY_WORD = "|".join(LIST_WORDS)

ORACLES = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op2_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op8_url_filter": f"""
        WITH u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages)
        SELECT page_id, host, path,
               CASE {' '.join(f"WHEN {fit} THEN '{rule}'" for fit, rule, _ in FITS)} END AS rule,
               CASE {' '.join(f"WHEN {fit} THEN '{verdict}'" for fit, _, verdict in FITS)}
                    WHEN regexp_matches(host, '(^|[.])({ANY_WORD})-({ANY_WORD})([.]|$)') THEN 'block'
                    ELSE 'allow' END AS verdict
        FROM u""",
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   CAST(coalesce(list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
            FROM s WHERE same),
        n AS (
            SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND place <= 5
             AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10""",
}
