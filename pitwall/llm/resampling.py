"""Importance resampling of documents towards a target set, by hashed n-gram models.

Words and word pairs are hashed into buckets. The share of each bucket among the target's n-grams and among all raw
n-grams, both smoothed, gives two generative models; a text's log weight is the sum of their log ratio over its
n-grams. A seeded Gumbel number for each document is added, and the k greatest sums are a sample without replacement
in proportion to the weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.arrays import _BASE, U64, flat, mix, slices, word_hashes
from pitwall.llm.packs import arrow_schema
from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

BUCKETS = 10_000
SMOOTHING = 1.0
# Rows among which the k-th value is looked up by sorting.
_FEW = 100_000


def _grams(batch: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word and of every pair of neighbouring words."""
    h, first = word_hashes(*flat(batch.column("_text")))
    row = np.repeat(np.arange(batch.num_rows), np.diff(first))
    pair = np.flatnonzero(row[1:] == row[:-1]) if len(row) else row
    both = mix(h[pair] * _BASE + h[pair + 1]) if len(pair) else h[:0]
    return (np.concatenate([h, both]) % U64(buckets)).astype(np.int64), np.concatenate([row, row[pair]])


def _counts(buckets: int, schema: pa.Schema):
    def run(batches):
        total = np.zeros((2, buckets), np.int64)
        for batch in slices(batches, "_text"):
            bucket, row = _grams(batch, buckets)
            chosen = batch.column("_target").to_numpy(zero_copy_only=False)[row].astype(bool)
            total[0] += np.bincount(bucket, minlength=buckets)
            total[1] += np.bincount(bucket[chosen], minlength=buckets)
        seen = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (seen, total[0][seen], total[1][seen])], schema=schema)

    return run


def log_ratios(docs: DataFrame, target: DataFrame, id_column: str, text_column: str, buckets: int = BUCKETS) -> np.ndarray:
    """Log of target share over raw share for every bucket; all documents are counted, also for the raw model."""
    ids = target.select(F.col(id_column).alias("_id")).dropna().distinct().withColumn("_target", F.lit(True))
    rows = docs.select(F.col(id_column).alias("_id"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    rows = rows.join(broadcast_if_small(materialise(ids, "target")), "_id", "left").select("_text", F.coalesce("_target", F.lit(False)).alias("_target"))
    schema = "bucket long, raw long, target long"
    counts = rows.mapInArrow(_counts(buckets, arrow_schema(schema)), schema).groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    table = np.zeros((2, buckets))
    for bucket, raw, wanted in counts.collect():  # one row per bucket
        table[:, bucket] = raw, wanted
    table += SMOOTHING
    share = table / table.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def _weights(ratios, buckets: int, schema: pa.Schema):
    def run(batches):
        for batch in slices(batches, "_text"):
            bucket, row = _grams(batch, buckets)
            weight = np.bincount(row, ratios.value[bucket], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("_u"), pa.array(weight)], schema=schema)

    return run


def resample(
    docs: DataFrame, target: DataFrame, k: int, id_column: str = "doc_id", text_column: str = "text",
    buckets: int = BUCKETS, seed: int = 11,
) -> DataFrame:
    """Struct ``row`` with all columns but the text, ``log_weight``, ``key`` (with its Gumbel number) and ``selected``.

    ``target`` names ids of ``docs``. A null or blank text has weight 0 in logs. Repeated rows have equal keys; of equal
    keys the smaller ids are taken, rows without an id last, and of wholly equal rows all or none.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, target, id_column, text_column, buckets))
    rest = F.struct(*(c for c in docs.columns if c != text_column)).alias("row")
    even = F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_column, text_column), 11)
    rows = docs.select(rest, ((even + 0.5) / float(1 << 53)).alias("_u"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    out = rows.select("row", "_u").schema.add("log_weight", "double")
    found = rows.mapInArrow(_weights(ratios, buckets, arrow_schema(out)), out)
    found = found.withColumn("key", F.col("log_weight") - F.log(-F.log("_u"))).drop("_u")
    found = materialise(found, "weights")
    order = F.struct(F.col("key").alias("key"), (-F.coalesce(F.col(f"row.{id_column}").cast("long"), F.lit((1 << 63) - 1))).alias("id"))
    return found.withColumn("selected", order >= _kth(found.select(order.alias("o")), k) if k > 0 else F.lit(False))


def _kth(ordered: DataFrame, k: int):
    """The k-th greatest value of the struct ``o`` (key, id): quantiles narrow the range until few rows are left."""
    low, high, above = None, None, 0
    while True:
        inside = ordered
        if low is not None:
            inside = inside.filter(F.col("o.key") >= low)
        if high is not None:
            inside = inside.filter(F.col("o.key") < high)
        n = inside.count()
        if n <= _FEW:
            break
        rank = 1 - min(1.0, (k - above) / n)
        near = [max(0.0, rank - 0.002), min(1.0, rank + 0.002)]
        a, b = inside.agg(F.percentile_approx("o.key", near, 10_000)).first()[0]
        over = ordered.filter(F.col("o.key") >= b).count()
        reach = ordered.filter(F.col("o.key") >= a).count()
        if over >= k:
            low, above = b, above
        elif reach >= k:
            low, high, above = a, b, over
        else:
            high, above = a, reach
        if (n == inside.count()) and a == b:
            break
    values = inside.orderBy(F.desc("o")).limit(k - above).agg(F.min("o").alias("o")).first()[0]
    if values is None:
        return F.struct(F.lit(float("-inf")).alias("key"), F.lit(-(1 << 63) + 1).alias("id"))
    return F.struct(F.lit(values["key"]).alias("key"), F.lit(values["id"]).alias("id"))
