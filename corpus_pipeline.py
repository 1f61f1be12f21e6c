"""The corpus pipeline: toxicity, near-duplicates, benchmark leaks, source mix, shards.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns
a DataFrame, which is written as Parquet and read again as the next one's docs.  All but the
last return the columns of ``docs``, whatever these are besides doc_id, text and source
(and, for the last, lang and n_chars); null, empty and repeated rows are as the operators
define.  An empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellforge.llm import containment, hilbert, mixing, ordinal, simhash
from cellforge.llm.tables import packed, stash, table, unstash, word_count

SHARDS = 24
SHARD_DIMS = ["source", "lang", "n_chars", "doc_id"]

#: SQL expresses neither the fitted model nor the fingerprints' hash nor the random rounding.
ORACLE_SQL = None


def _text_hash() -> Column:
    return F.xxhash64("text")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose odds of any toxicity reach REJECT go; null and empty texts stay."""
    model = ordinal.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(packed(docs), "text")
    scored = ordinal.score_toxicity(rows, model)
    return scored.where(F.col("toxic_odds") < ordinal.REJECT).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the least doc_id."""
    return simhash.first_of_each(docs, "doc_id", "text")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item to 0.8 or more of its shingles go."""
    hashed = docs.select("text", _text_hash().alias("hash")).where("text is not null")
    held = containment.contained_items(hashed, table(spark, sf_dir, "benchmark"), "hash")
    held = stash(held.select(F.col("doc").alias("leak")).distinct(), "leaks")
    rows = docs.select(packed(docs), _text_hash().alias("hash"))
    return rows.join(held, F.col("hash") == F.col("leak"), "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, 0 to 3 times."""
    sized = docs.select("doc_id", _text_hash().alias("hash"), "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix_sources(sized, ["doc_id", "hash"], "source", "size", per_row=False)
    mixed = stash(mixed.where("copies > 0").select("doc_id", "hash", "source", "copies"), "mixed").alias("m")
    rows = docs.select(packed(docs), "doc_id", _text_hash().alias("hash"), "source").alias("r")
    same = F.expr("r.doc_id <=> m.doc_id and r.hash = m.hash and r.source <=> m.source")
    return rows.join(mixed, same).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``curve``, ``shard`` and ``slot``, written in that order."""
    return hilbert.hilbert_shards(docs, SHARD_DIMS, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing", mixing_stage),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; what
    the next stage has read is deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
        if before is not None:
            unstash(before)
        before = docs
    return docs
