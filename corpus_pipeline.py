"""Documents through language ID, near-duplicate removal, repeated-passage removal, mixing and tokenization.

Every stage but the last returns the columns of documents. ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.llm import bpe, jaccard, mixing, ppm, suffix
from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

LEAST_SCORE = 0.5


def language(spark, docs, sf_dir):
    """Documents with letters whose language is clear; the model learns from the documents that name theirs."""
    model = ppm.fit(docs.select("doc_id", "text", "lang"))
    found = ppm.identify(docs, model).filter((F.col("lang_pred") != ppm.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return found.select("row.*")


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of linked documents, that of the smallest id, and every document that links none.

    Rows that repeat an id are documents of their own here; of wholly equal rows one stays. A row without an id stays.
    """
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = materialise(repeated, "repeated")
    if repeated.isEmpty():
        groups = jaccard.near_duplicates(docs)
        gone = materialise(groups.filter("id <> component_id").select(F.col("id").alias("doc_id")).distinct(), "gone")
        return docs.join(broadcast_if_small(gone), "doc_id", "left_anti")
    # such rows are named by their content, below all ids
    own = F.lit(-(1 << 62)) - F.shiftrightunsigned(F.xxhash64(*docs.columns), 2)
    known = broadcast_if_small(repeated.withColumn("_again", F.lit(True)))
    named = docs.join(known, "doc_id", "left").withColumn("_name", F.when(F.col("_again"), own).otherwise(F.col("doc_id"))).drop("_again")
    groups = materialise(jaccard.near_duplicates(named, "_name").select("id", "component_id").distinct(), "groups")
    ids = named.select(F.col("_name").alias("id"), "doc_id").distinct()
    first = ids.join(groups, "id").groupBy("component_id").agg(F.min(F.struct("doc_id", "id")).alias("first"))
    stay = materialise(first.select(F.col("first.id").alias("_name")), "stay")
    kept = named.filter("_name is not null").join(broadcast_if_small(stay), "_name", "left_semi")
    first = F.row_number().over(Window.partitionBy("_name").orderBy("text", "lang", "source", "n_chars"))
    several = kept.filter(F.col("_name") <= F.lit(-(1 << 62))).withColumn("_first", first).filter("_first = 1").drop("_first")
    single = kept.filter(F.col("_name") > F.lit(-(1 << 62)))
    found = single.unionByName(several).unionByName(named.filter("_name is null"))
    return found.select(docs.columns)


def repeats(spark, docs, sf_dir):
    """Documents without the passages that earlier ones hold; those of which nothing is left go.

    Half of a character at a cut becomes the replacement character.
    """
    found = suffix.remove_repeats(docs).filter("n_removed = 0 or n_removed < n_bytes")
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    found = found.select("row.*", F.when((F.col("n_bytes") > 0), text).otherwise(F.lit("")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mix(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    found, _ = mixing.mix(docs)
    times = F.explode(F.array_repeat(F.lit(0), F.col("repeats")))
    return found.filter("repeats > 0").select("row.*", times.alias("_time")).drop("_time")


def tokens(spark, docs, sf_dir):
    """Token counts and digests of every document that the mix took."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return found.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("mixing sources", mix),
    ("byte-level BPE", tokens),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
