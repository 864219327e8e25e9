"""The text operators as registered queries, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vaultwright.llm import (
    bpe,
    collocations,
    context_mixing,
    html_text,
    line_dedup,
    piece_sampling,
    prob_minhash,
    quality_rules,
    quotation_linking,
    sql,
    template_decontamination,
    toxicity,
    warc,
    whitening,
)
from vaultwright.llm.common import table

TEXT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TEXT_ORACLES: dict[str, str] = {}


def text_query(sql: str | None = None):
    def register(function):
        TEXT_QUERIES[function.__name__] = function
        if sql is not None:
            TEXT_ORACLES[function.__name__] = sql
        return function

    return register


@text_query(sql.quality_rules())
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    counts = [F.col(c).cast("long").alias(c) for c in quality_rules.BASE]
    return judged.select("doc_id", *counts, "base_failed", "kept", F.array_join("failed", ",").alias("failed"))


@text_query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
    g AS (SELECT payload_digest, max(page_id) AS kept FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
    SELECT d.page_id, d.payload_bytes, d.payload_digest,
           CASE WHEN d.page_id < g.kept THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN d.page_id < g.kept THEN g.kept END AS refers_to
    FROM d LEFT JOIN g ON g.payload_digest = d.payload_digest AND d.payload_bytes >= 1000
    """
)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = warc.new_archive_folder(pages)
    index = warc.write_archives(pages, folder)
    records = warc.read_records(index, folder, with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@text_query()
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@text_query()
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@text_query(sql.near_duplicates())
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prob_minhash.document_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size")


@text_query()
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@text_query()
def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = piece_sampling.Vocabulary.load(piece_sampling.default_model())
    return piece_sampling.encode(table(spark, sf_dir, "documents"), vocabulary, k=3, checked=True)


@text_query()
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = template_decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "n_windows", "item_windows", "n_slots", "n_agreeing")


@text_query(sql.quotation_linking())
def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotation_linking.link(table(spark, sf_dir, "conversations"))


@text_query()
def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(table(spark, sf_dir, "documents"))


@text_query()
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.load(bpe.default_vocabulary())
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    digested = encoded.withColumn("ids_sha256", bpe.ids_digest("ids"))
    decoded = bpe.decode(digested, vocabulary, keep_ids=False)
    return decoded.withColumn("decoded_sha256", F.sha2(F.col("text").cast("binary"), 256)).drop("text")


@text_query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@text_query(sql.collocations())
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


@text_query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
