"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into segments, and the different codes are indexed by each segment's value. A query's segments are
looked up at growing radius: after radius r in all segments and r + 1 in the first j, every code within
(r + 1) * segments + j - 1 bits has been met. A query is done when its k-th distance is within that. Candidates enter
only if they are no farther than the k-th distance so far. Rows with equal codes are one entry, so a very common code
is met once.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.session import materialise

SEGMENT_BITS = 16
# Radius up to which all segments are searched in one step.
_JOINT = 2


def sign_codes(vectors: DataFrame, id_column: str, vector_column: str, dims: int) -> DataFrame:
    """(id, code): bit i of the words in ``code`` tells whether dimension i is above zero; null vectors are left out."""
    word = "aggregate(transform(slice({v}, {a}, 64), (x, i) -> if(x > 0, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)"
    words = [F.expr(word.format(v=f"`{vector_column}`", a=64 * w + 1)) for w in range(max(1, ceil(dims / 64)))]
    rows = vectors.filter(F.col(vector_column).isNotNull() & F.col(id_column).isNotNull())
    return rows.select(F.col(id_column).cast("long").alias("id"), F.array(*words).alias("code"))


def _distance(a: str, b: str, words: int):
    return sum((F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w])) for w in range(words)), F.lit(0))


def top_k(codes: DataFrame, queries: DataFrame, k: int, bits: int, segment_bits: int | None = None) -> DataFrame:
    """(query_id, rank, id, distance): for every row of ``queries`` (id, code) the ``k`` nearest rows of ``codes``
    (id, code) in Hamming distance, ties by smaller id; fewer if there are fewer rows.

    Rows that repeat an id count once per code. A query that is itself among the codes finds itself. Without queries
    or codes the result is empty.
    """
    index = materialise(codes.groupBy("code").agg(F.countDistinct("id").alias("many")), "codes")
    size = index.count()
    width = segment_bits or max(SEGMENT_BITS, round(log2(max(size, 2))))
    segments, words = ceil(bits / width), ceil(bits / 64)

    def segment(code: str, s: int):
        """Bits s * width and on, which may reach into the next word."""
        word, shift = divmod(s * width, 64)
        value = F.shiftrightunsigned(F.col(code)[word], shift)
        if shift + width > 64 and word + 1 < words:
            value = value.bitwiseOR(F.shiftleft(F.col(code)[word + 1], 64 - shift))
        return value.bitwiseAND(F.lit((1 << min(width, bits - s * width)) - 1))

    def parts(code: str, chosen):
        return F.explode(F.array(*(F.struct(F.lit(s).alias("s"), segment(code, s).alias("v")) for s in chosen)))

    by_segment = index.select("code", "many", parts("code", range(segments)).alias("p")).select("code", "many", "p.s", "p.v")
    by_segment = materialise(by_segment, "segments")
    wanted = queries.select(F.col("code").alias("query")).distinct()
    wanted = materialise(wanted, "queries")
    best, open_ = None, wanted.withColumn("most", F.lit(bits))
    steps = [(r, range(segments)) for r in range(_JOINT + 1)]
    steps += [(r, [s]) for r in range(_JOINT + 1, width + 1) for s in range(segments)]
    each = Window.partitionBy("query")
    nearer = each.orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
    upto = each.orderBy("distance").rangeBetween(Window.unboundedPreceding, 0)
    for radius, chosen in steps:
        probes = open_.select("query", "most", parts("query", chosen).alias("p"))
        flips = ",".join(str(sum(1 << b for b in c)) for c in combinations(range(width), radius))
        flips = F.split(F.lit(flips), ",").cast("array<bigint>")
        probes = probes.select("query", "most", "p.s", F.explode(flips).alias("f"), F.col("p.v").alias("v"))
        probes = probes.select("query", "most", "s", F.col("v").bitwiseXOR(F.col("f")).alias("v"))
        met = probes.join(by_segment, ["s", "v"]).withColumn("distance", _distance("query", "code", words))
        met = met.filter("distance <= most").select("query", "code", "many", "distance")
        if best is not None:
            met = met.unionByName(best.select("query", "code", "many", "distance"))
        met = met.distinct().withColumns({"nearer": F.coalesce(F.sum("many").over(nearer), F.lit(0)), "upto": F.sum("many").over(upto)})
        met = met.filter(F.col("nearer") < k)
        enough = F.max("upto").over(each) >= k
        best = met.withColumn("most", F.when(enough, F.max("distance").over(each)).otherwise(bits))
        best = materialise(best.select("query", "code", "many", "distance", "most"), "best")
        covered = (radius + 1) * segments - 1 if len(chosen) == segments else radius * segments + chosen[0]
        state = best.select("query", "most").distinct()
        open_ = wanted.join(state, "query", "left").select("query", F.coalesce("most", F.lit(bits)).alias("most"))
        open_ = open_.filter(F.col("most") > covered)
        if open_.isEmpty():
            break
    done = best.select("query", "code", "distance")

    first = Window.partitionBy("code").orderBy("id")
    members = codes.select("code", "id").distinct().join(done.select("code").distinct(), "code", "left_semi")
    members = members.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= k).drop("_n")
    found = done.join(members, "code").select("query", "distance", "id")
    order = Window.partitionBy("query").orderBy("distance", "id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    asked = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct()
    return asked.join(found, "query").select("query_id", "rank", "id", "distance")
