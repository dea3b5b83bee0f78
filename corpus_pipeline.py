"""From raw documents to packed sequences: five stages, each one operator over all that the stage before kept.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; ``run`` writes it as Parquet to the shared folder and
reads it back as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yardstar.llm import line_dedup, mixing, ngram_join, packing, quality
from yardstar.llm.common import materialize

#: SQL can't express the classifier, the tokenizer and the hash-random order of the mix.
ORACLE_SQL = None

#: Rows of whole texts that Spark gives to Python at once: its own 10,000 are tens of megabytes, held by both sides.
BATCH_ROWS = 2_000


def _unused(docs: DataFrame, name: str) -> str:
    """A working name that no column of the input has, in any case of its letters."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn ``labels.quality`` from the documents and keep those that score 0.7 or more."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)  # holds for the stages after it, too
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, label_col="quality")
    score = _unused(docs, "_score")
    return quality.score(docs, model, score_col=score).where(quality.predict(score) == 1).select(*docs.columns)


def site_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that stand in more than a twentieth of their source's documents; ``n_chars`` follows the text."""
    kept = line_dedup.drop_boilerplate(docs, "source", "text", ratio=0.05, min_pages=5)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars.cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each group linked by 5-word Jaccard similarity >= 0.8.

    Rows are decided on one by one: rows that share an id but not the text are
    documents of their own, and of rows that share both one stays. Rows without
    an id stay.
    """
    named = docs.where("doc_id IS NOT NULL")
    repeated = named.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        found = ngram_join.jaccard_components(docs, percent=80)
        dropped = found.where("doc_id != component_id").select("doc_id")
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    # Numbers of rows in the order of ids take the place of the ids.
    row, number = _unused(docs, "_row"), F.monotonically_increasing_id()
    rows = materialize(named.orderBy("doc_id", F.xxhash64("text")).withColumn(row, number), "numbered-documents")
    found = ngram_join.jaccard_components(rows, id_col=row, percent=80)
    dropped = found.where(f"{row} != component_id").select(row)
    kept = rows.join(dropped, row, "left_anti").select(*docs.columns)
    # Texts without words link with nothing; equal ones of one id are still one document.
    once = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    kept = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each source's share of all words: documents come once for each epoch, the one at the cut in part."""
    mixed = materialize(mixing.mix(docs, weights=(5, 2, 1), most_epochs=3), "mix")
    return mixing.take(docs, mixed)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the ids of all rows into sequences of at most 2048; a row for each piece."""
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)
    return packing.piece_table(packed)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", site_line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
