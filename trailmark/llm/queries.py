"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import ann, bpe, chat, collocations, fingerprints, lexical, licenses, mixing, pii, simhash, topk, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bpe_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_archives(warc.archive(_table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = F.lit("<|im_end|><|im_start|>assistant ok")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), says.alias("text"))
    out = chat.format_conversations(turns.unionByName(probe))
    back = F.transform(chat.read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    out = out.select("conv_id", F.size(back).cast("long").alias("n_turns"), F.sha2(F.array_join(back, ""), 256).alias("turns_sha256"), chat.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels"))).select("doc_id", "score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(_table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {"op1_bpe": op1_bpe, "op2_ann": op2_ann, "op3_warc": op3_warc, "op4_licenses": op4_licenses, "op5_chat": op5_chat, "op6_pii": op6_pii, "op7_toxicity": op7_toxicity, "op8_mixing": op8_mixing, "op9_topk": op9_topk, "op10_simhash": op10_simhash, "op11_collocations": op11_collocations, "op12_fingerprints": op12_fingerprints, "op13_lexical": op13_lexical}
