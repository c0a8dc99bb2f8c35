"""The corpus pipeline: raw documents to packed training sequences.

Five stages, each calling one operator of ``rankloom.llm``.  A stage is a
function (spark, docs, sf_dir) -> DataFrame over everything its predecessor
kept; all but the last return the columns of documents.

Further columns of documents, whatever their names (score, predicted,
held_out, kept, n_lines, size, target, _key, _id ...), go through every stage
but the last with their values: a stage gives them names of its own while its
operator works.  Packing returns its pieces alone.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import lines, mix, packing, quality, simhash
from rankloom.llm.common import table
from rankloom.session import materialize


#: The columns that the stages work on; all others are set aside.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def aside(stage):
    """The stage with all other columns under names that no operator uses."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        held = {c: f"extra {i} of documents" for i, c in enumerate(names) if c not in COLUMNS}
        out = stage(spark, docs.toDF(*[held.get(c, c) for c in names]), sf_dir)
        back = {v: k for k, v in held.items()}
        return out.toDF(*[back.get(c, c) for c in out.columns])

    return run_stage


@aside
def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    judged = quality.classify(docs, table(spark, sf_dir, "labels"), metadata=("n_chars",), keep=docs.columns)
    return judged.filter("predicted = 1").select(*docs.columns)


@aside
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines stay in one document only; a text may become empty."""
    out = lines.dedup_lines(docs).withColumn("text", F.col("kept"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@aside
def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    return simhash.keep_first(docs)


@aside
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each whole time that the mix takes a document, and one cut
    after the last word it takes for a part; what it doesn't take goes."""
    return mix.apply_mix(mix.mix_sources(docs)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mix with its place in a sequence."""
    return packing.pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("quality", filter_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("mix", mix_sources),
    ("packing", pack),
]

#: Scores, fingerprints and packing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row; what passes between two is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
