"""The registered queries of this package: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellforge.llm import chat, containment, hilbert, hyperlang, lm, merkle, mixing, ordinal, quality, repeats, reputation, simhash, whitening
from cellforge.llm.tables import stash, table, word_count

SHARDS = 24
SHARD_DIMS = ["source", "lang", "n_chars", "doc_id"]
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]
KEPT_POSTERIOR = 0.5


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted; the digests are read back from
    the formatted string and its loss spans."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"))
    for name, kind in (("uri", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int")):
        part = part.withField(name, F.lit(None).cast(kind))
    messages = rows.unionByName(extra).select("conv_id", "turn", "role", F.array(part).alias("parts"))
    formatted = chat.format_chats(messages)

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digests(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for text, marks in zip(texts, spans):
            turns, whole = chat.read_back(text), hashlib.sha256()
            for role, parts in turns:
                whole.update(f"{role}\n{''.join(p[1] for p in parts)}\n".encode())
            loss = "".join(chat.unescape(text[m["start"] : m["stop"]]) for m in marks)
            out.append((len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
        return pd.DataFrame(out, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", digests("formatted", "loss_spans").alias("d")).select("conv_id", "d.*")


def op2_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards along the Hilbert curve of their metadata; law ``rows``."""
    docs = table(spark, sf_dir, "documents").select(
        *SHARD_DIMS,
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    cut = hilbert.hilbert_shards(docs, SHARD_DIMS, SHARDS)
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, and whether the weakly supervised model keeps it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = stash(quality.with_counts(docs).drop("text"), "quality-counts")  # texts are counted once
    voted = counted.withColumn("votes", quality.votes())
    model = quality.label_model(voted)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    posterior = model.posterior(F.col("votes"))
    return voted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (posterior >= KEPT_POSTERIOR)).alias("kept"), posterior.alias("posterior"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component that links of 3 bits lead to."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix_sources(docs, ["doc_id"], "source", "size")
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of the documents with another remainder than 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = lm.score_documents(docs.withColumn("train", ~held_out), "train")
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's odds of toxicity, expected severity and likeliest grade."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = ordinal.score_toxicity(docs, model)
    return scored.select("doc_id", "toxic_odds", "severity", "grade", (F.col("toxic_odds") >= ordinal.REJECT).alias("toxic"))


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged; a page's outcome is bad where its label says low quality or
    toxic (labels share the pages' ids; most pages have none)."""
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = pages.join(labels, pages["page_id"] == labels["doc_id"], "left").drop("doc_id")
    judged = reputation.judge_urls(labelled, "url", "bad", URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "bad_rate")


def op9_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds to 0.8 or more."""
    pairs = containment.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.withColumnRenamed("doc", "doc_id").withColumnRenamed("item", "item_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's predicted language; those with remainder 2 teach nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = hyperlang.fit_prototypes(docs.where(~held_out))
    told = hyperlang.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding's first four whitened components; the fit sees each distinct
    vector once."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root; every second one, by its id's checksum, is
    verified as read without its line ends."""
    docs = table(spark, sf_dir, "documents")
    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 1, F.lit(True))
    read = F.when(odd, F.col("text")).otherwise(F.translate("text", "\n", ""))
    manifest = merkle.build_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], seen={"text": read})
    return merkle.audit(manifest).withColumnRenamed("id", "doc_id").drop("member")


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of 100 bytes that also start earlier."""
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return cleaned.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_formatting, op2_hilbert_sharding, op3_quality_rules, op4_simhash, op5_mixing, op6_lm_scoring, op7_toxicity,
        op8_url_reputation, op9_benchmark_containment, op10_language, op11_whitening, op12_merkle_manifest, op13_repeats,
    )
}
