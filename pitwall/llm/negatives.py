"""Hard negatives by exact integer scores: Strassen products of anchor and candidate tiles, and mergeable heaps.

Vectors become integers. Anchors and candidates are dealt to cells, each a block of anchors against a block of
candidates of bounded bytes, so that no cell grows with the tables or with a label. A cell multiplies its two tiles,
padded with zeros, by Strassen's seven recursive products over 64-bit integers; additions and products are exact
modulo 2^64, so every score that fits a long is right.

A first pass keeps, per anchor and cell, the heap of the best candidates of the anchor's label; heaps merge into the
anchor's positives. Their scores give windows. A second pass keeps, per anchor, positive and cell, the heap of the best
candidates of other labels inside the window; these merge into the negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.llm.packs import arrow_schema
from pitwall.session import materialise

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Bytes of a cell's two tiles, and rows of the tiles that are multiplied at once.
ANCHOR_BYTES, CANDIDATE_BYTES = 1 << 20, 8 << 20
TILE_ANCHORS, TILE_CANDIDATES = 256, 2048
# Sides up to which tiles are multiplied directly.
LEAF = 64
_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max

_HEAP = "anchor long, slot int, id long, uid long, score long"


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two int64 matrices modulo 2^64; odd sides are padded with zeros at each level."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= LEAF:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def best(scores: np.ndarray, allowed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``size`` highest allowed scores of each row, all if fewer; the first columns win ties."""
    masked = np.where(allowed, scores, _NONE)
    if masked.shape[1] > size:
        least = np.partition(masked, masked.shape[1] - size, axis=1)[:, masked.shape[1] - size]
        allowed = allowed & (masked >= least[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, -masked[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    keep = np.arange(len(row)) - first[row] < size
    return row[keep], column[keep]


def window_of(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score n with 50 p <= 100 n <= 95 p, without leaving 64 bits."""
    return -((-positive) // 2), positive + (-positive) // 20


def _tile(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a list column as rows, shorter ones padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    counts = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    inside = np.arange(dims) < counts[:, None]
    out[inside] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _longest(column: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for c in column.chunks), default=0)


def _merge(held: list[tuple[np.ndarray, ...]], size: int) -> tuple[np.ndarray, ...]:
    """The ``size`` best entries of each (anchor, slot) of several heaps: highest score, smallest id, smallest row."""
    anchor, slot, id_, uid, score = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((uid, id_, -score, slot, anchor))
    anchor, slot, id_, uid, score = (c[order] for c in (anchor, slot, id_, uid, score))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])
    begin = np.flatnonzero(new)
    rank = np.arange(len(anchor)) - begin[np.cumsum(new) - 1] if len(anchor) else np.zeros(0, np.int64)
    keep = rank < size
    return tuple(c[keep] for c in (anchor, slot, id_, uid, score))


def _cell(windows: bool, size: int, schema: pa.Schema):
    """The heaps of a cell: of the positives, or of each positive's window."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        heap = tuple(np.zeros(0, np.int64) for _ in range(5))
        if anchors.num_rows and rows.num_rows:
            ids = _ids(rows.column("id"))
            order = np.lexsort((rows.column("uid").to_numpy(), ids))
            rows, ids = rows.take(pa.array(order)), ids[order]
            uids, labels = rows.column("uid").to_numpy(), rows.column("label").to_numpy()
            dims = max(_longest(anchors.column("vector")), _longest(rows.column("vector")))
            for a in range(0, anchors.num_rows, TILE_ANCHORS):
                part = anchors.slice(a, TILE_ANCHORS)
                left = _tile(part.column("vector"), dims)
                own, own_label = part.column("uid").to_numpy(), part.column("label").to_numpy()
                slots = _slots(part) if windows else [(np.zeros(len(own), np.int64), None)]
                for c in range(0, rows.num_rows, TILE_CANDIDATES):
                    piece = slice(c, c + TILE_CANDIDATES)
                    scores = strassen(left, _tile(rows.column("vector").slice(c, TILE_CANDIDATES), dims).T)
                    same = own_label[:, None] == labels[piece]
                    held = [heap]
                    for slot, (number, positive) in enumerate(slots):
                        if windows:
                            least, most = window_of(positive)
                            allowed = ~same & (number >= 0)[:, None] & (scores >= least[:, None]) & (scores <= most[:, None])
                        else:
                            allowed = same & (own[:, None] != uids[piece])
                        r, k = best(scores, allowed, size)
                        held.append((own[r], np.full(len(r), slot, np.int64), ids[piece][k], uids[piece][k], scores[r, k]))
                    heap = _merge(held, size)
        return pa.Table.from_arrays([_shown(c, t) for c, t in zip(heap, schema.types, strict=True)], schema=schema)

    return run


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Ids as numbers; a missing id comes last."""
    return column.fill_null(_LAST).to_numpy()


def _shown(values: np.ndarray, dtype: pa.DataType) -> pa.Array:
    return pa.array(values).cast(dtype)


def _slots(part: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each place among the positives: whether an anchor (row) has one there, and its score."""
    held = [{p["place"]: p["score"] for p in row} for row in part.column("positives").to_pylist()]
    out = []
    for slot in range(POSITIVES):
        scores = [row.get(slot) for row in held]
        out.append((np.array([-1 if s is None else slot for s in scores]), np.array([s or 0 for s in scores], np.int64)))
    return out


def integer_vectors(rows: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """(id, label, vector of longs) of the rows that take part: neither label nor vector null, all components finite."""
    component = lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
    taken = F.col(label_column).isNotNull() & F.col(vector_column).isNotNull() & F.forall(vector_column, component)
    whole = F.transform(vector_column, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.filter(taken).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), whole.alias("vector")
    )


def _cells(rows: DataFrame, anchors: DataFrame, blocks: int, slices: int, windows: bool, size: int) -> DataFrame:
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # columns of their own, as both sides come from one table
    left = anchors.select(*(F.col(c).alias(c) for c in anchors.columns))
    left = left.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")).withColumn("part", every(slices))
    right = rows.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(1)), F.lit(slices)).cast("int")).withColumn("block", every(blocks))
    left, right = left.groupBy("block", "part"), right.groupBy("block", "part")
    return left.cogroup(right).applyInArrow(_cell(windows, size, arrow_schema(_HEAP)), _HEAP)


def _merged(heaps: DataFrame, size: int) -> DataFrame:
    """The heaps of all cells in one per (anchor, slot), with ranks from 0."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "uid")
    return heaps.withColumn("rank", F.row_number().over(order) - 1).filter(F.col("rank") < size)


def mine(rows: DataFrame, anchors: str = "id % 50 = 0") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all rows that ``anchors`` selects.

    ``rows`` has id, label and vector (see ``integer_vectors``); other columns are left alone. Scores are integer inner
    products; shorter vectors count as padded with zeros, empty ones score 0. Components beyond a long are the nearest
    long, and scores beyond it wrap around. Higher scores come first, ties by smaller id, a null id last. Rows that
    repeat an id are rows of their own: each is mined as an anchor and may be another one's positive. A row without an
    id is an anchor only if the condition says so. An anchor without positives, or a positive without a negative in its
    window, gives no row; a positive score below 0 has an empty window. Empty tables give none.
    """
    numbered = materialise(rows.select("id", "label", "vector").withColumn("uid", F.monotonically_increasing_id()), "vectors")
    bytes_ = F.coalesce(F.sum(F.size("vector") * 8), F.lit(0))
    chosen = numbered.filter(anchors)
    blocks = chosen.agg(bytes_).first()[0] // ANCHOR_BYTES + 1
    slices = numbered.agg(bytes_).first()[0] // CANDIDATE_BYTES + 1

    positives = _merged(_cells(numbered, chosen.select("uid", "label", "vector"), blocks, slices, False, POSITIVES), POSITIVES)
    positives = materialise(positives.select("anchor", F.col("rank").alias("place"), "id", "score"), "positives")
    entry = F.struct("place", "score")
    held = positives.groupBy(F.col("anchor").alias("uid")).agg(F.collect_list(entry).alias("positives"))
    wanted = chosen.select("uid", "label", "vector").join(held, "uid")
    found = _merged(_cells(numbered, wanted, blocks, slices, True, NEGATIVES), NEGATIVES)
    found = found.select("anchor", F.col("slot").alias("place"), "rank", F.col("id").alias("_negative"), F.col("score").alias("_below"))
    named = found.join(positives, ["anchor", "place"]).join(chosen.select(F.col("uid").alias("anchor"), F.col("id").alias("_own")), "anchor")
    known = lambda c: F.nullif(F.col(c), F.lit(_LAST))
    return named.select(
        F.col("_own").alias("anchor_id"),
        known("id").alias("positive_id"),
        (F.col("rank") + 1).cast("int").alias("rank"),
        known("_negative").alias("negative_id"),
        F.col("score").alias("positive_score"),
        F.col("_below").alias("negative_score"),
    )
