"""From raw documents to training text: five stages, each an operator of ``chronoframe.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm import bitmaps, byte_bpe, decontam, ngram_join, substring_dedup
from chronoframe.llm import toxicity as _toxicity
from chronoframe.llm.storage import checkpointed
from chronoframe.session import ensure_checkpoint_dir, share_package

#: The stages have no SQL form (learnt scores, alignment, tokens); tests hold them against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the toxicity score rejects (0.3 or more) go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = _toxicity.fit(docs.select("doc_id", "text"), labels)
    return _toxicity.score(docs, model, threshold=0.3).where(F.col("predicted") == 0).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles the one with the least id stays; rows without an id stay."""
    found = ngram_join.components(docs.select("doc_id", "text"), 5, 80)
    gone = checkpointed(found.where("component_id <> doc_id").select("doc_id").distinct())
    return bitmaps.without(docs, "doc_id", gone, "doc_id").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages of 50 that an earlier document has too are cut; ``n_chars`` follows the text."""
    cut = substring_dedup.dedup(docs, 50, outputs=("kept_text",))
    return cut.withColumn("text", F.col("kept_text")).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that aligns with a benchmark item go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, their count, and hashes of the ids and of the decoded bytes."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # executors still hold what the stages before have grown to: remember fewer pieces (more time, the same ids)
    return byte_bpe.encode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, remember=150_000).drop("text")


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("benchmark_decontamination", benchmark_leaks),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    root = ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = f"{root}/pipeline-{spark.sparkContext.applicationId}-{k}-{name}"
        out.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
