"""Corpus pipeline over ``documents``: quality, near-dedup, decontamination, PII, tokens.

Each stage takes (spark, docs, sf_dir) and works on everything that the stage before kept.

1. quality: documents predicted to be of low quality go; labels come from ``labels``.
2. near_dedup: one document of each near-duplicate component stays (the smallest doc_id).
3. decontaminate: documents that leak a passage of ``benchmark`` go.
4. pii: personal data is replaced by its kind in brackets; n_chars follows the new text.
5. tokens: doc_id, n_tokens, ids and the SHA-256 of the decoded text.

Rows with a null doc_id stay as they are at stages 1 to 3 if their text passes. Rows that repeat
a kept doc_id with equal text are copies: one of them stays. Rows that share a doc_id but not a
text go at stage 2 only together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm import bpe, common, decontam, minhash, pii, quality
from fileflow.llm.common import among, materialize, table
from fileflow.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, out="quality__score", flag="quality__keep")
    return scored.where("quality__keep = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs, words=5, percent=80)
    ids = (found.where("doc_id is not null").groupBy(F.col("doc_id").alias("gone__id"))
           .agg(F.max("kept").alias("kept"), F.count("*").alias("n")))
    ids = materialize(ids, "pipeline-ids")
    gone, same = ids.where("not kept").select("gone__id"), F.col("doc_id") == F.col("gone__id")
    if gone.count() <= common.BROADCAST_IDS:
        kept = docs.join(F.broadcast(gone), same, "left_anti")
    else:                                    # only texts that may go have to meet the ids
        maybe, stay = among(docs, "doc_id", gone, "gone__id")
        kept = maybe.join(gone, same, "left_anti").union(stay)
    if ids.where("n > 1").isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).union(
        kept.where("doc_id is null"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark"), out="leak__found")
    return found.where("size(leak__found) = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(pii.detect(docs))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(docs.select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage),
          ("decontaminate", decontaminate_stage), ("pii", pii_stage), ("tokens", tokens_stage)]

#: A learnt classifier and similarity components: not SQL. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
