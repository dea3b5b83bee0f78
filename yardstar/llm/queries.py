"""One query for each operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstar.llm import (
    conversations,
    html,
    licenses,
    line_dedup,
    mixing,
    near_vectors,
    negatives,
    ngram_join,
    packing,
    quality,
    token_files,
    topk,
    url_rules,
)
from yardstar.session import configure, shared_dir

URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), percent=80)


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.TEMPLATES, containment=0.8)


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)
    return packing.piece_table(packed)


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", k=5)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), label_col="quality")
    return quality.score(docs, model).select(
        "doc_id", quality.is_held_out("doc_id").alias("held_out"), "score", quality.predict().alias("predicted")
    )


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, "source", "text", ratio=0.05, min_pages=5)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = f"{shared_dir(spark)}/yardstar/llm/{spark.sparkContext.applicationId}/token-files-{uuid.uuid4().hex}"
    token_files.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(
        table(spark, sf_dir, "embeddings"),
        "vec_id % 50 = 0",
        label="if(vec_id % 7 = 0, (label + 1) % 10, label)",
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    repaired = conversations.repair(conversations.damage(given), copies=F.col("copies"))
    return conversations.summary(given, repaired)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_vectors,
        op2_ngram_jaccard,
        op3_source_mix,
        op4_license_scan,
        op5_url_rules,
        op6_best_fit_packing,
        op7_exact_top_k,
        op8_quality,
        op9_main_text,
        op10_line_dedup,
        op11_token_files,
        op12_hard_negatives,
        op13_conversation_repair,
        pipeline,
    )
}
