"""Near-duplicate documents by an exact, size-aware join of their word-shingle sets.

Two documents link when the Jaccard similarity of their sets of 5-word shingles is at least 0.8.

* Equal sets are one node, the smallest id.
* Of the shingles of a set in order of their hashes, neighbours that any partner holds as neighbours too are at least
  as many as the two have in common, less those that only one has, as each of these parts one pair at most. Sets of
  which fewer pairs of neighbours, among the first n / 2 + 8 shingles, occur in another set are alone. Chance meetings
  of pairs stay rare however large the input is.
* Light sets, up to a boundary x: every subset of the size that a link of n and m shingles must share is a key. Sets
  that share a key link, no comparison needed, so each key gives a star.
* Heavy sets: a set of n shingles shares at least t = ceil(0.8 n) with any partner, so the first shingle that both
  hold, in any fixed order, stands among its first n - t + 1. These make inverted lists, those of the fewest sets
  first. All in a list are
  compared with one leader, which may come from another list. Members that this leaves in different components are
  joined on what sets them apart from the leader: sets of n and m shingles link if and only if at most (n + m) / 9
  shingles are in one of them only, and a shingle is in one of A and B only if it is in one of A - L and B - L only,
  for any L. So for differences of a and b shingles, ceil((a + b - (n + m) / 9) / 2) have to be common, and the first
  common one stands among the first n / 4 + 1 of both. Large lists of such differences get stars of their own first;
  then pairs that share one are compared. A large family of copies that do not link makes few such pairs.
* x is where the estimated number of subset keys plus list entries and comparisons is least.

Equal shingles are equal 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm.arrays import _BASE, U64, flat, giving_back, giving_back_group, mix, shingle_sets, slices
from pitwall.llm.graphs import components
from pitwall.llm.packs import arrow_schema, bytes_of, least, runs, values_of
from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

SHINGLE = 5
PACK = 1 << 20
# Bytes of text for each bucket of packed shingles, and the shingles of it that are judged at a time, in some 40 bytes
# each. A set has an answer in most buckets, so small inputs have many too.
BUCKET, BUCKETS_LEAST = 24 << 20, 32
JUDGED = 1 << 19
# Largest size for which subsets are considered at all, and list entries that one comparison of two texts is worth.
LIGHT_MOST = 24
COMPARE_COST = 50
# Members of a list that are compared in pairs without another star, and rounds of stars in a row that may not pay.
PAIRS_MOST = 256
UNPAID_MOST = 3
# Rows, each with up to two texts, that a task's Python gets at once.
BATCH_ROWS = 500
# Shingles of so many sets or more are ordered by their number of sets; the table of them has a bounded size.
OFTEN, OFTEN_ROWS = 16, 500_000

_SETS = "id long, n long, low long, high long, need long"
_PACKED = "bucket long, h binary, keys binary, counts binary"
_ANSWERS = "low long, shared long, h long, sets long"
_APART_COLUMNS = ("leader", "h", "id", "component", "n", "size", "at")
_APART = ", ".join(f"{c} long" for c in _APART_COLUMNS)
_KEYS = "key long, light boolean, id long, n long, rare long"


def must_share(n: int) -> int:
    """Shingles that a set of ``n`` has in common with any set it links to."""
    return -(-4 * n // 5)


def link_share(n: int, m: int) -> int:
    """Shingles that sets of ``n`` and ``m`` have in common if and only if they link."""
    return -(-4 * (n + m) // 9)


def spare(n: int) -> int:
    return max(1, n // 20)


def pair_front(n):
    """The first shingles of a set of ``n`` whose pairs of neighbours are counted."""
    return np.minimum(n, n // 2 + 8)


def pairs_needed(n: int) -> int:
    """Pairs of neighbours in the front of a set of ``n`` that are also such pairs in that of any other set it links to.

    Of two sets that have ``both`` in common, the first shingles in common stand in both fronts, and every shingle of
    one set only parts one pair of them at most. More in common only means more pairs. ``n``, which is more than there
    are, if no other set can link.
    """
    m = np.arange(must_share(n), n * 5 // 4 + 1)
    both = link_share(n, m)
    m, both = m[both <= np.minimum(n, m)], both[both <= np.minimum(n, m)]
    m, both = m[both < np.maximum(n, m)], both[both < np.maximum(n, m)]
    in_fronts = np.minimum(np.minimum(pair_front(n) - (n - both), pair_front(m) - (m - both)), both)
    return int(np.min(in_fronts - 1 - (n + m - 2 * both), initial=n))


def _digest(shingles: np.ndarray, seed: int) -> np.int64:
    with np.errstate(over="ignore"):
        return mix(np.array([mix(shingles + U64(seed)).sum(dtype=np.uint64) + U64(len(shingles))]))[0].astype(np.int64)


def _sets_of(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    return shingle_sets(*flat(batch.column("_text")), size)


def _describe(size: int, schema: pa.Schema):
    def run(batches):
        need = cache(pairs_needed)  # made here, as a cached function of a module cannot be sent to tasks
        parts = (len, lambda s: _digest(s, 1), lambda s: _digest(s, 2), lambda s: need(len(s)))
        for batch in slices(batches, "_text"):
            sets = _sets_of(batch, size)
            columns = [pa.array(np.array([f(s) for s in sets], np.int64)) for f in parts]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], schema=schema)

    return run


def _front(shingles: np.ndarray, pairs: bool) -> np.ndarray:
    n = len(shingles)
    if not pairs:
        return shingles[: n - must_share(n) + spare(n)]
    first = shingles[: pair_front(n)]
    return mix(first[:-1] * _BASE + first[1:])


def _deal_fronts(buckets: int, size: int, pairs: bool, schema: pa.Schema):
    """The first shingles of each different set of a task, or the pairs of neighbours among them, by bucket."""

    def flush(held):
        h = np.concatenate([s for _, s in held])
        key = np.repeat(np.array([k for k, _ in held], np.int64), [len(s) for _, s in held])
        bucket = (h % U64(buckets)).astype(np.int64)
        order = np.lexsort((key, bucket))
        bucket, key, h = bucket[order], key[order], h[order]
        begin = np.flatnonzero(runs(bucket))
        for a, b in zip(begin, [*begin[1:], len(h)], strict=True):
            new = np.flatnonzero(runs(key[a:b]))
            counts = np.diff(np.append(new, b - a))
            yield pa.RecordBatch.from_pylist(
                [{"bucket": int(bucket[a]), "h": bytes_of(h[a:b], 6), "keys": key[a:b][new].tobytes(), "counts": counts.tobytes()}],
                schema,
            )

    def run(batches):
        held, known, total = [], set(), 0
        for batch in slices(batches, "_text"):
            for s in _sets_of(batch, size):
                if not len(s) or (key := _digest(s, 1)) in known:
                    continue
                known.add(key)
                if len(own := _front(s, pairs)):
                    held.append((key, own))
                    total += len(own)
            if total >= PACK:
                yield from flush(held)
                held, known, total = [], set(), 0
        if held:
            yield from flush(held)

    return run


def _judge_fronts(often: int, pairs: bool, schema: pa.Schema):
    """Of pairs: how many of a set other sets have too. Of shingles: those of many sets, and sums of lists."""

    def judged(rows: list[dict], part: int, parts: int) -> list[np.ndarray]:
        """Of the hashes whose upper bits give ``part``: sets with the shared ones of each, hashes of many sets with their sets, sums."""
        held = []
        for r in rows:
            h, counts = values_of(r["h"], 6), np.frombuffer(r["counts"], np.int64)
            own = np.flatnonzero((h >> U64(32)) % U64(parts) == part)
            held.append((h[own], np.repeat(np.frombuffer(r["keys"], np.int64), counts)[own]))
        h, key = map(np.concatenate, zip(*held, strict=True))
        del held
        order = np.lexsort((key, h))
        h, key = h[order], key[order]
        different = runs(h, key)
        h, key = h[different], key[different]
        new = runs(h)
        begin = np.flatnonzero(new)
        sets = np.diff(np.append(begin, len(h)))
        if pairs:
            return np.unique(key[sets[np.cumsum(new) - 1] > 1], return_counts=True)
        many, lists = sets >= often, sets > 1
        return h[begin][many].astype(np.int64), sets[many], sets[lists].sum(), lists.sum()

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = min(256, 1 + sum(len(r["h"]) for r in rows) // 6 // JUDGED)
        found = [judged(rows, part, parts) for part in range(parts)]
        none = lambda k: pa.nulls(k, pa.int64())
        if pairs:
            sets, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            shared = np.bincount(at, np.concatenate([n for _, n in found]), len(sets)).astype(np.int64)
            columns = [pa.array(sets), pa.array(shared), none(len(sets)), none(len(sets))]
        else:
            h, sets = (np.concatenate(x) for x in list(zip(*found, strict=True))[:2])
            entries, lists = (int(sum(x)) for x in list(zip(*found, strict=True))[2:])
            # the last row counts the entries and the lists of two sets or more
            columns = [
                none(len(h) + 1),
                pa.concat_arrays([none(len(h)), pa.array([entries])]),
                pa.concat_arrays([pa.array(h), none(1)]),
                pa.array(np.append(sets, lists).astype(np.int64)),
            ]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _level(shingles: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """In how many sets shingles occur, by powers of two; 0 for all that are not in the table."""
    common, level = often
    if not len(common):
        return np.zeros(len(shingles), np.int64)
    low = shingles & U64((1 << 48) - 1)
    at = np.minimum(np.searchsorted(common, low), len(common) - 1)
    return np.where(common[at] == low, level[at], 0)


def _subset_keys(shingles: np.ndarray, boundary: int) -> list[int]:
    """A key for every subset that a link to a set of up to ``boundary`` shingles needs."""
    n, keys = len(shingles), []
    values = [int(v) for v in mix(shingles + U64(3))]
    total, wrap = sum(values), (1 << 64) - 1
    for m in range(must_share(n), min(boundary, n * 5 // 4) + 1):
        share = link_share(n, m)
        if share > min(n, m):
            continue
        salt = (min(n, m) * 1000 + max(n, m)) * 0x9E3779B97F4A7C15
        keys += [(total - sum(left) + salt) & wrap for left in combinations(values, n - share)]
    return keys


def _keys(often, boundary: int, size: int, schema: pa.Schema):
    def run(batches):
        for batch in slices(batches, "_text"):
            ids = batch.column("_id").to_numpy()
            keys, light, owner, sizes, rare = [], [], [], [], []
            for i, s in enumerate(_sets_of(batch, size)):
                n, own, few = len(s), [], 0
                if n <= boundary:
                    own.append(np.array(_subset_keys(s, boundary), np.uint64))
                if n * 5 // 4 > boundary:
                    rank = _level(s, often.value)
                    own.append(s[np.lexsort((s, rank))][: n - must_share(n) + 1])
                    few = int((rank == 0).sum())
                for part in own:
                    keys.append(mix(part))
                    light += [part is own[0] and n <= boundary] * len(part)
                    owner += [ids[i]] * len(part)
                    sizes += [n] * len(part)
                    rare += [few] * len(part)
            keys = np.concatenate(keys).astype(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((keys, light, owner, sizes, rare), schema.types, strict=True)], schema=schema)

    return run


def _linked(size: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            last, sets, keep = {}, {}, []
            for side in ("_a_text", "_b_text"):
                last[side] = (None, None)
            for i, (a, b) in enumerate(zip(batch.column("_a_text"), batch.column("_b_text"), strict=True)):
                for side, text in (("_a_text", a.as_py()), ("_b_text", b.as_py())):
                    if last[side][0] != text:
                        raw = np.frombuffer(text, np.uint8)
                        last[side] = (text, shingle_sets(raw, np.array([0, len(raw)]), size)[0])
                x, y = last["_a_text"][1], last["_b_text"][1]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 80 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).cast(schema)

    return run


def _differences(often, size: int, schema: pa.Schema):
    """The first shingles that a leader and a member do not share: the member's own before the leader's, rare ones first.

    Sets of n and m shingles that link differ in at most (n + m) / 9 of them, which is at most n / 4, and the first one
    that both have apart from the leader stands at most one later.
    """

    def run(batches):
        for batch in slices(batches, "_b_text"):
            sets = [
                [shingle_sets(*flat(batch.column(side).slice(i, 1)), size)[0] for side in ("_a_text", "_b_text")]
                for i in range(batch.num_rows)
            ]
            own = [np.concatenate([np.setdiff1d(b, a, True), np.setdiff1d(a, b, True)]) for a, b in sets]
            own = [o[np.lexsort((o, _level(o, often.value), np.isin(o, a)))] for o, (a, _) in zip(own, sets, strict=True)]
            size_of = np.array([len(o) for o in own], np.int64)
            own = [o[: len(b) // 4 + 1] for o, (_, b) in zip(own, sets, strict=True)]
            many = np.array([len(o) for o in own], np.int64)
            spread = {c: np.repeat(batch.column(c).to_numpy(), many) for c in ("a", "b", "component")}
            at = np.concatenate([np.arange(1, k + 1) for k in many])
            n = np.repeat([len(b) for _, b in sets], many)
            columns = (spread["a"], np.concatenate(own).astype(np.int64), spread["b"], spread["component"], n, np.repeat(size_of, many), at)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def _pair_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left = texts.select(F.col("_id").alias("a"), F.col("_text").alias("_a_text"))
    right = texts.select(F.col("_id").alias("b"), F.col("_text").alias("_b_text"))
    return pairs.join(left, "a").join(right, "b")


def _verify(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    both = _pair_texts(pairs, texts).select("a", "b", "_a_text", "_b_text")
    return both.mapInArrow(giving_back(_linked(size, arrow_schema("a long, b long"))), "a long, b long")


def _thin(links: DataFrame, apart: DataFrame, texts: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Links found by stars inside large lists of differences, and the differences with the components that result.

    A family whose members all differ from their leader in the same way meets in one list. There all are compared with
    one of them, for as long as the lists with more than ``PAIRS_MOST`` members have more pairs of different components
    than the lists have rows, and the stars spare more pairs than their comparisons are worth: many small families in a
    list would need a round each. The lists stay whole: what the stars leave apart is still joined.
    """
    members = apart.filter("at = 1").groupBy("leader").agg(F.count("id").alias("many")).filter(F.col("many") > PAIRS_MOST)
    members = materialise(members.select("leader"), "wide_leaders")
    if members.isEmpty():
        return links, apart
    large, found, turn = materialise(apart.join(broadcast_if_small(members), "leader"), "wide_lists"), None, 0
    rows, pairs, worth, unpaid = large.count(), None, 0, 0
    while True:
        chance = F.xxhash64("id", F.lit(turn))
        inside = large.groupBy("leader", "h", "component").agg(
            F.count("id").alias("many"),
            F.min(chance).alias("chance"),
            F.min_by(F.struct("id", "component", "n", "size"), chance).alias("hub"),
        )
        all_pairs = F.sum("many").cast("double") * F.sum("many") - F.sum(F.col("many").cast("double") * F.col("many"))
        lists = inside.groupBy("leader", "h").agg(
            F.sum("many").alias("many"), (all_pairs / 2).alias("pairs"), F.min_by("hub", "chance").alias("hub")
        )
        hubs = materialise(lists.filter((F.col("pairs") > 0) & (F.col("many") > PAIRS_MOST)), "inner_hubs")
        before, pairs = pairs, hubs.agg(F.sum("pairs")).first()[0] or 0
        unpaid = unpaid + 1 if before is not None and before - pairs < worth else 0
        if pairs <= rows or unpaid == UNPAID_MOST:
            break
        met = large.join(hubs.select("leader", "h", "hub"), ["leader", "h"]).filter(
            (F.col("component") != F.col("hub.component"))
            & (F.least("n", "hub.n") * 5 >= F.greatest("n", "hub.n") * 4)
            & (F.abs(F.col("size") - F.col("hub.size")) <= F.floor((F.col("n") + F.col("hub.n")) / 9))
        )
        stars = materialise(met.select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct(), "inner_stars")
        more = materialise(_verify(stars, texts, size), "inner_links")
        worth, turn = COMPARE_COST * stars.count() + 1, turn + 1
        if more.isEmpty():
            continue
        links = materialise(links.union(more), "links")
        found = components(links)
        large = materialise(_renamed(large, found), "wide_lists")
    return links, apart if found is None else materialise(_renamed(apart, found), "apart")


def _renamed(apart: DataFrame, labels: DataFrame) -> DataFrame:
    """The differences with the components of ``labels``."""
    named = labels.select("id", F.col("component").alias("_now"))
    return apart.join(named, "id", "left").withColumn("component", F.coalesce("_now", "component")).select(*_APART_COLUMNS)


def light_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The size up to which subset keys cost less than list entries and comparisons."""

    def subsets(n):
        return sum(comb(n, min(n, link_share(n, m))) for m in range(must_share(n), n * 5 // 4 + 1) if link_share(n, m) <= min(n, m))

    def scan(n):
        return (n - must_share(n) + 1) * list_length + COMPARE_COST * list_length

    costs = {}
    for x in range(LIGHT_MOST + 1):
        costs[x] = sum(k * subsets(n) for n, k in sizes.items() if n <= x)
        costs[x] += sum(k * scan(n) for n, k in sizes.items() if x < n or n * 5 // 4 > x)
    return min(costs, key=costs.get)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Send tasks' Python few rows at a time: a row may hold two long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``; the component is the smallest id that links reach.

    Words are longest runs of other bytes than the space and 0x09-0x0D, A-Z lower-cased. A text of fewer than
    ``size`` words is one shingle; null and blank texts have none and are their own component. Rows that repeat an id
    are one document with several texts, which links whatever any of them links; its rows without words show the id. A
    row without an id has no component and links nothing. Empty tables give no rows.
    """
    # all work in Python is done when this returns
    with _small_batches(docs.sparkSession):
        return _near_duplicates(docs, id_column, text_column, size)


def _near_duplicates(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit("").cast("binary")).alias("_text")
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), text)
    sets = materialise(rows.mapInArrow(giving_back(_describe(size, arrow_schema(_SETS))), _SETS), "sets")
    known = rows.filter("_id is not null")

    def judged(texts: DataFrame, pairs: bool) -> DataFrame:
        buckets = (texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0) // BUCKET + BUCKETS_LEAST
        packed = texts.mapInArrow(giving_back(_deal_fronts(buckets, size, pairs, arrow_schema(_PACKED))), _PACKED)
        return packed.groupBy("bucket").applyInArrow(giving_back_group(_judge_fronts(OFTEN, pairs, arrow_schema(_ANSWERS))), _ANSWERS)

    shared = judged(known, True).groupBy("low").agg(F.sum("shared").alias("shared"))
    classes = sets.filter("n > 0 and id is not null").groupBy("low", "high", "n").agg(F.min("id").alias("rep"), F.min("need").alias("need"))
    alive = classes.join(shared, "low").filter(F.col("shared") >= F.greatest(F.lit(1), "need"))
    alive = materialise(alive.select("low", "high", "n", "rep"), "alive")
    texts = known.join(broadcast_if_small(alive.select(F.col("rep").alias("_id")).distinct()), "_id")
    texts = materialise(texts.dropDuplicates(["_id", "_text"]), "texts")

    answers = materialise(judged(texts, False), "fronts")
    sizes = {r.n: r["count"] for r in alive.filter(f"n <= {2 * LIGHT_MOST}").groupBy("n").count().collect()}
    entries, shared_lists = answers.filter("h is null").agg(F.sum("shared"), F.sum("sets")).first()
    boundary = light_boundary(sizes, entries / shared_lists if shared_lists else 0.0)
    often, limit = answers.filter("h is not null"), OFTEN
    while often.filter(F.col("sets") >= limit).count() > OFTEN_ROWS:
        limit *= 2
    common = often.filter(F.col("sets") >= limit).select("h", "sets").orderBy("h").toPandas()
    order = common.h.to_numpy(np.int64).astype(np.uint64), np.log2(common.sets.to_numpy(np.float64)).astype(np.int64)
    order = docs.sparkSession.sparkContext.broadcast(order)
    keys = texts.mapInArrow(giving_back(_keys(order, boundary, size, arrow_schema(_KEYS))), _KEYS)
    keys = materialise(keys.distinct(), "keys")

    hubs = keys.filter("light").groupBy("key").agg(F.min("id").alias("hub"))
    links = keys.filter("light").join(hubs, "key").filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    lists = keys.filter("not light").select("key", "id", "n", "rare")
    fits = F.least("n", "m") * 5 >= F.greatest("n", "m") * 4

    # every list against its leader, the text that meets most others in its lists: it stands nearest to the text that a
    # family of copies comes from. That is the first member, or the first of the leaders that this one meets elsewhere
    many = lists.groupBy("key").agg(F.count("id").alias("many")).filter("many > 1")
    lists = materialise(lists.join(many, "key"), "lists")
    degree = lists.groupBy("id", "n").agg(F.struct(-F.sum("many"), F.min("rare"), F.xxhash64("id")).alias("rank"))
    lists = materialise(lists.select("key", "id", "n").join(degree, ["id", "n"]), "lists")
    leaders = lists.groupBy("key").agg(F.min_by(F.struct("id", "n", "rank"), "rank").alias("led"))
    leaders = leaders.select("key", F.col("led.id").alias("leader"), F.col("led.n").alias("m"), F.col("led.rank").alias("above"))
    leaders = materialise(leaders, "leaders")
    chosen = leaders.select(F.col("leader").alias("id"), F.col("m").alias("n")).distinct()
    met = lists.select("key", "id", "n").join(chosen, ["id", "n"]).join(leaders, "key").filter(fits)
    better = F.min_by(F.struct("leader", "m"), "above")
    better = materialise(met.groupBy("id", "n").agg(better.alias("to")).select("id", "n", "to.leader", "to.m"), "better")
    second = better.select(F.col("id").alias("leader"), F.col("n").alias("m"), F.struct("leader", "m").alias("to"))
    better = better.join(second, ["leader", "m"]).select(F.col("id").alias("leader"), F.col("n").alias("m"), "to")
    led = lists.join(leaders.join(better, ["leader", "m"]).select("key", "to.leader", "to.m"), "key")
    led = materialise(led.select("key", "id", "n", "leader", "m"), "led")
    stars = led.filter((F.col("id") != F.col("leader")) & fits).select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    stars = materialise(stars, "stars")
    links = materialise(links.union(_verify(stars, texts, size)), "star_links")
    # rows of one id with different texts are one document
    several = sets.filter("n > 0 and id is not null").select("id", "low", "high", "n")
    ids = several.groupBy("id").agg(F.min("low").alias("a"), F.max("low").alias("b")).filter("a <> b").select("id")
    of_id = several.join(materialise(ids, "repeated_ids"), "id").join(classes, ["low", "high", "n"])
    links = materialise(links.union(of_id.select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()), "links")
    labels = components(links)

    # what is left: members of one list in different components. A leader's lists are joined again on what sets them
    # apart from the leader, where members of a family have little in common
    named = led.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    open_keys = named.groupBy("key").agg((F.min("component") != F.max("component")).alias("open")).filter("open")
    groups = named.join(open_keys.select("key"), "key").select("leader", "id", "component").distinct()
    groups = materialise(groups.filter("id <> leader"), "groups")
    open_leaders = groups.groupBy("leader").agg((F.min("component") != F.max("component")).alias("open")).filter("open")
    groups = groups.join(open_leaders.select("leader"), "leader")
    apart = _pair_texts(groups.select(F.col("leader").alias("a"), F.col("id").alias("b"), "component"), texts)
    apart = materialise(apart.mapInArrow(giving_back(_differences(order, size, arrow_schema(_APART))), _APART), "apart")
    links, apart = _thin(links, apart, texts, size)
    # of two members the one with fewer differences shows the first common one among its first n / 8 + 1
    other = apart.filter("at <= n div 8 + 1")
    other = other.select("leader", "h", *(F.col(c).alias(f"o_{c}") for c in ("id", "component", "n", "size", "at")))
    apart_most = F.floor((F.col("n") + F.col("o_n")) / 9)
    common = F.ceil((F.col("size") + F.col("o_size") - apart_most) / 2)
    rest = apart.join(other, ["leader", "h"]).filter(
        (F.col("component") != F.col("o_component"))
        & (F.struct("size", "id") > F.struct("o_size", "o_id"))
        & (F.least("n", "o_n") * 5 >= F.greatest("n", "o_n") * 4)
        & (F.col("size") - F.col("o_size") <= apart_most)
        & (F.col("at") <= F.col("size") - common + 1)
        & (F.col("o_at") <= F.col("o_size") - common + 1)
    )
    rest = materialise(rest.select(F.col("id").alias("a"), F.col("o_id").alias("b")).distinct(), "rest")
    # first one pair for each document; pairs that this connects need no look any more
    links = materialise(links.union(_verify(rest.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), texts, size)), "links")
    labels = components(links)
    near, far = (labels.select(F.col("id").alias(c), F.col("component").alias(f"{c}_in")) for c in ("a", "b"))
    rest = rest.join(near, "a", "left").join(far, "b", "left")
    rest = materialise(rest.filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b"), "rest")
    more = materialise(_verify(rest, texts, size), "more_links")
    if not more.isEmpty():
        labels = components(links.union(more))

    named = classes.join(labels, classes.rep == labels.id, "left").select("low", "high", "n", F.coalesce("component", "rep").alias("_component"))
    return sets.join(named, ["low", "high", "n"], "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("_component", "id")).alias("component_id")
    )
