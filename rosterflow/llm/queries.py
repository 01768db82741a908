"""One query per operator with production parameters, each over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm import (
    chat,
    exact_dedup,
    infill,
    language,
    line_dedup,
    mixing,
    packing,
    phrases,
    pseudo,
    quality,
    resampling,
    simhash,
    toxicity,
)
from rosterflow.llm.common import held_out
from rosterflow.session import checkpoint_root, stage


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), [5, 2, 1], 1.5)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    words = stage(pseudo.word_counts(docs), "word-counts")
    counts = pseudo.count(docs, words)
    encoded = pseudo.encode(docs, counts)
    return pseudo.score(encoded, counts, pseudo.train(encoded, counts), words)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), quality.train_rows())
    out = held_out(F.col("doc_id"), 5, 0).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", out, "severity", "grade", "toxic")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).drop("at")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digests(chat.expand(turns.unionByName(more)))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.edit_trial(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), quality.train_rows())
    scored = quality.score(docs, model)
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", predicted)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = documents(spark, sf_dir), held_out(F.col("doc_id"), 3, 1)
    found = language.identify(docs, language.fit(docs, ~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    keys = line_dedup.line_keys(docs)
    index = line_dedup.create(spark, f"{checkpoint_root(spark)}/lines-{uuid.uuid4().hex}")
    cleaned = line_dedup.clean(docs, line_dedup.insert(index, keys), keys)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = stage(infill.store(documents(spark, sf_dir).select("doc_id", "text")), "frames")
    found = infill.digests(infill.transform(stored))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_simhash": op6_simhash,
    "op7_packing": op7_packing,
    "op8_fingerprints": op8_fingerprints,
    "op9_quality": op9_quality,
    "op10_language_id": op10_language_id,
    "op11_line_dedup": op11_line_dedup,
    "op12_resampling": op12_resampling,
    "op13_infill": op13_infill,
}
