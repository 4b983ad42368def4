"""One query for each text operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import alignment, bpe, html_content, language_id, lexical, ngram_lm, packing, repetition, rule_ensemble, simhash, token_counts, topk, toxicity
from millrace.llm.common import fold, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op2_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 10) == 0
    model = ngram_lm.fit(docs.where(~held_out))
    scored = ngram_lm.score(docs.select("doc_id", "text", held_out.alias("held_out")), model, keep=("doc_id", "held_out"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(table(spark, sf_dir, "documents"))


def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = rule_ensemble.fit(docs, labels.where(fold("doc_id", 5) != 0), "quality")
    return rule_ensemble.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), is_query="vec_id % 50 = 0", k=5)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    learned = language_id.fit(language_id.training(docs, held_out))
    return language_id.predict(docs.select("doc_id", "text"), learned).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted"
    )


def op9_html_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_content.extract(pages, html_content.fit(pages))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), "toxic")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return toxicity.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_simhash, op2_ngram_lm, op3_repetition, op4_rule_ensemble, op5_byte_bpe, op6_topk, op7_token_counts, op8_language_id, op9_html_content, op10_packing, op11_toxicity, op12_lexical, op13_alignment)}
ORACLES: dict[str, str] = {
    "op6_topk": """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM scored
)
SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 5
""",
    "op12_lexical": r"""
WITH cut AS (
    SELECT row_number() OVER () AS doc, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), facts AS (
    SELECT count(*) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM cut WHERE len(terms) > 0
), held AS (
    SELECT doc, doc_id, len(terms) AS n_terms, term, count(*) AS tf
    FROM (SELECT doc, doc_id, terms, unnest(terms) AS term FROM cut) GROUP BY doc, doc_id, n_terms, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2.0 * n + 2.0) / (2.0 * count(*) + 1.0))) AS BIGINT) AS w FROM held CROSS JOIN facts GROUP BY term, n
), asked AS (
    SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)
), scores AS (
    SELECT item_id, doc, doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n_terms * n) // l)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) CROSS JOIN facts GROUP BY item_id, doc, doc_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS "rank" FROM scores WHERE score > 0
)
SELECT item_id, "rank", doc_id, score FROM ranked WHERE "rank" <= 10
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES
