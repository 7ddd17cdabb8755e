"""A corpus from raw documents to token ids: STAGES, each written and read again as the next one's input.

Null and empty texts fail the quality rules and go; rows that repeat an id are judged each by its own text, and of rows that are
alike in everything the near-duplicate stage keeps one. Empty tables pass through. Ties are settled by the smallest id.
"""
import public_tokenizers
from pyspark.sql import functions as F

from postlens.llm import bpe, hyperminhash, line_dedup, mixing, quality_rules
from postlens.scratch import settle
from postlens.session import configure

#: Threshold on the Jaccard index of five-word shingles, in per cent.
SIMILARITY = 80


def quality(spark, docs, sf_dir):
    """Documents that break no quality rule."""
    return quality_rules.keep_good(docs)


def lines(spark, docs, sf_dir):
    """Texts without the lines that many sites share; of each such line the copy with the smallest id stays."""
    return line_dedup.clean(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return hyperminhash.drop_near_duplicates(docs, SIMILARITY)


def mixture(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.draw(docs)


def tokens(spark, docs, sf_dir):
    """Ids of every document, and whether they decode to its text."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "source", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("mixture", mixture),
          ("tokens", tokens)]

#: Shingle components, hashes and byte pairs are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the whole table of documents."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
