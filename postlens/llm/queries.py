"""The registered queries of the corpus operators, with production parameters over whole tables."""
import public_tokenizers
from pyspark.sql import functions as F

from postlens.llm import (
    bpe,
    chat,
    forest,
    hyperminhash,
    licenses,
    line_dedup,
    merkle,
    mixing,
    oracles,
    quality_bayes,
    quality_rules,
    sharding,
    toxic_spans,
    whitening,
)
from postlens.session import configure


def table(spark, sf_dir, name):
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark, sf_dir):
    """Token ids and decoded text of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_hilbert_shards(spark, sf_dir):
    """Sixteen shards of near equal bytes along the curve."""
    return sharding.assign(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def op6_mix(spark, sf_dir):
    """What the mix takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def op10_quality_rules(spark, sf_dir):
    """Measures and verdict of every document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
        F.array_join("quality.broken", ",").alias("broken"))


def op3_license_scan(spark, sf_dir):
    """Base phrases and detected licenses of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_forest_dedup(spark, sf_dir):
    """Links and components of all embeddings at a cosine of 0.95."""
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), 0.95)


def op5_quality_bayes(spark, sf_dir):
    """Posterior quality of every document."""
    return quality_bayes.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_dedup(spark, sf_dir):
    """Lines before, lines removed and a digest of what is left of every document."""
    done = line_dedup.removed_lines(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8_hyperminhash(spark, sf_dir):
    """Components of documents whose shingle sets reach a Jaccard index of 0.85."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), 85)


def op9_chat(spark, sf_dir):
    """Every conversation, and one made of control strings, formatted and read back."""
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    written = chat.conversations(rows.unionByName(odd))
    read = written.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                          chat.read_loss(F.col("formatted"), F.col("loss")).alias("answers"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("answers").cast("long").alias("loss_chars"), F.sha2("answers", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op11_merkle_exchange(spark, sf_dir):
    """Proofs of every document, folded from a leaf whose text is lowered for one id in five or so."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(table(spark, sf_dir, "documents"), {
        "text": F.when(struck, merkle.lowered("text")).otherwise(F.col("text"))})
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_toxic_crf(spark, sf_dir):
    """Toxicity of every document; labels of one id in five or so are never learnt from."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = toxic_spans.score(docs, toxic_spans.fit(docs, labels.where(~held))).select("doc_id", held.alias("held_out"), "toxicity.*")
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_toxic", F.array_join(
        F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("spans"))


def op13_block_whitening(spark, sf_dir):
    """The first 32 whitened components of every usable embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 32)


QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_hilbert_shards, op3_license_scan, op4_forest_dedup, op5_quality_bayes, op6_mix, op7_line_dedup,
    op8_hyperminhash, op9_chat, op10_quality_rules, op11_merkle_exchange,
    op12_toxic_crf, op13_block_whitening)}
ORACLES = dict(oracles.ORACLES)
