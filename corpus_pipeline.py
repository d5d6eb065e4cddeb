"""From raw documents to encoded training text: five stages, each one operator of stayflow.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import bpe, line_runs, minhash, mixing, toxicity
from stayflow.llm.rows import Work, free_name

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; null and empty texts are kept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = free_name(docs, "score")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), out=score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs, ``n_chars`` as the text is now. A
    document that consists of such copies alone goes; null and empty texts are kept."""
    done = line_runs.remove_repeated_runs(docs)
    emptied = (F.size("removed_lines") > 0) & (F.trim(F.coalesce("text", F.lit(""))) == "")
    changed = F.when(F.size("removed_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.where(~emptied).withColumn("n_chars", changed).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group linked by shared five-word shingles."""
    groups = minhash.near_duplicates(docs)
    gone = free_name(docs, "gone")
    dropped = groups.where("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col(gone), "left_anti").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that language and quality domains near their smoothed shares of
    all tokens. Rates are at least 1, so no document is lost. Labels are those of documents
    that came this far; without any the documents stay as they are."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality is not null")
    labelled = docs.select("doc_id", "lang").join(labels.select("doc_id", "quality"), "doc_id")
    labelled = labelled.select("doc_id", F.concat_ws("-", "lang", "quality").alias("domain"))
    if labelled.isEmpty():
        return docs
    rates = mixing.mix(docs, labelled, settings=mixing.Settings(keep_all=True))
    return mixing.repeat_by_rate(docs, rates)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their number of tokens, packed token ids, and whether the ids decode to
    the text again. Columns of the same names are replaced."""
    kept = [c for c in docs.columns if c not in ("n_tokens", "token_ids", "decodes")]
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    again = free_name(encoded, "decoded")
    decoded = bpe.decode(encoded, RANKS, out=again)
    text = F.coalesce("text", F.lit("")).cast("binary")
    tokens = (F.octet_length("token_ids") / 4).cast("long")
    return decoded.select(
        *kept, tokens.alias("n_tokens"), "token_ids", (F.col(again) == text).alias("decodes")
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near-duplicate removal", near_dedup_stage),
    ("mixing to target weights", mixing_stage),
    ("byte-level BPE", encoding_stage),
]

# The classifier, the signatures and the tokenizer are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read by the next."""
    work = Work(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
