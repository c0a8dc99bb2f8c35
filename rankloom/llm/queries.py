"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, extract, lines, lm, mix, packing, quality, repeats, resample, search, simhash, sketch, toxicity
from .common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sketch.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch.as_text(own).alias("fingerprint"), sketch.as_text(edited).alias("edited_fingerprint"),
        sketch.resemblance(own, edited).alias("near_edited"), sketch.resemblance(own, after).alias("near_next"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every document whose id is divisible by 100."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    asked = docs.filter("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id")
    return search.search(docs, asked)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    out = quality.classify(docs, table(spark, sf_dir, "labels"), metadata=("n_chars",), keep=["doc_id"])
    return out.select("doc_id", "held_out", "score", "predicted")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.classify(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    return out.select("doc_id", "held_out", "score", "predicted")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix.take(mix.with_size(docs).drop("text")).select("doc_id", *mix.OUTPUT)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep=["page_id", "url"])
    return out.select("page_id", "url", "text", "n_chars")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample.resample(docs, table(spark, sf_dir, "benchmark").select("text"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_packing": op2_packing,
        "op3_bm25_topk": op3_bm25_topk,
        "op4_quality": op4_quality,
        "op5_repeats": op5_repeats,
        "op6_line_dedup": op6_line_dedup,
        "op7_simhash": op7_simhash,
        "op8_toxicity": op8_toxicity,
        "op9_source_mix": op9_source_mix,
        "op10_main_text": op10_main_text,
        "op11_collocations": op11_collocations,
        "op12_resample": op12_resample,
        "op13_lm_score": op13_lm_score,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_dedup": lines.DEDUP_SQL,
        "op9_source_mix": mix.TAKEN_SQL,
    }
