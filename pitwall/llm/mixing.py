"""Mixing of overlapping sources to target weights by a min-cost flow.

Documents are aggregated by the set of sources that they belong to. A flow routes each set's words to the quotas of
its sources: the first copy of a word costs nothing, the second one unit, so repetition is used last. What a set has to
give is then taken in whole documents, by a seeded hash: from each size class, larger documents first, those of least
hash up to about the share of its class in what is still missing. What a class gives too much or too little changes the
shares of the classes of smaller documents. Where those cannot hold the rest, the class is cut document by document and
the one document is added that comes nearest. What then still differs is lessened by one document more, less, or for
another. That is near, not nearest: other choices of several documents are not searched.

Only aggregates reach the driver: one row per set of sources, and per set and size class.
"""

from __future__ import annotations

from collections import deque
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
COPIES = 2
SHARE = Fraction(3, 2)
_UNITS = 4096
_UNIT_BITS = 50
_ALL = 1 << 62
_NONE = (0, [], [])
_WALKED = "_set string, _class int, cut long, most long, part long, left long"
_SWAPS = "_set string, _class int, _at long, taken boolean"


def targets(sizes: dict, weights: dict, total: Fraction, copies: int = COPIES) -> dict:
    """Shares of ``total`` by weight, none above ``copies`` times its size; what is above goes to the others."""
    out = {s: Fraction(copies * sizes[s]) for s in sizes}
    open_, left = set(sizes), Fraction(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] >= out[s] * weight}
        if not full:
            out.update({s: left * weights[s] / weight for s in open_})
            break
        left -= sum(out[s] for s in full)
        open_ -= full
    return out


def route(capacity: dict[tuple, int], quota: dict, copies: int = COPIES) -> dict[tuple, dict]:
    """Words that each set of sources gives to each of its sources: quotas are met as far as they can be, at least cost.

    Successive cheapest paths over a graph of sets and sources; the k-th copy of a set's words costs k - 1.
    """
    start, end = "start", "end"
    room: dict = {}
    price: dict = {}

    def arc(a, b, most, cost):
        room[a, b], room[b, a] = most, 0
        price[a, b], price[b, a] = cost, -cost

    for p, size in capacity.items():
        for k in range(copies):
            arc(start, ("copy", k, p), size, k)
            arc(("copy", k, p), ("set", p), size, 0)
        for s in p:
            arc(("set", p), ("source", s), copies * size, 0)
    for s, words in quota.items():
        arc(("source", s), end, words, 0)
    near: dict = {}
    for a, b in room:
        near.setdefault(a, []).append(b)
    while True:
        cost, back, queue = {start: 0}, {}, deque([start])
        while queue:
            a = queue.popleft()
            for b in near.get(a, ()):
                if room[a, b] > 0 and cost[a] + price[a, b] < cost.get(b, float("inf")):
                    cost[b], back[b] = cost[a] + price[a, b], a
                    queue.append(b)
        if end not in back:
            break
        path, b = [], end
        while b != start:
            path.append((back[b], b))
            b = back[b]
        flow = min(room[e] for e in path)
        for a, b in path:
            room[a, b] -= flow
            room[b, a] += flow
    return {p: {s: room[("source", s), ("set", p)] for s in p} for p in capacity}


def _walk(pdf):
    """The cuts of one set's classes, larger documents first: what stands before ``cut`` is taken.

    A class is cut between units, runs of its documents in hash order, at the end nearest to its share. If the smaller
    classes cannot hold what is then left, the walk stops at the unit from ``cut`` to ``most``.
    """
    left, below, out = int(pdf["left"].iloc[0]), int(pdf["words"].sum()), []
    for c in sorted(set(pdf["_class"]), reverse=True):
        units = pdf[pdf["_class"] == c].sort_values("least")
        words, least, most = (units[n].to_numpy() for n in ("words", "least", "most"))
        upto, part = np.cumsum(words), int(units["part"].iloc[0])
        own = int(upto[-1])
        below -= own
        if part < 0:
            part = left * own // (own + below)
        k = int(np.searchsorted(upto, part, "right"))
        got = int(upto[k - 1]) if k else 0
        if k < len(words) and got + words[k] <= left and (left - got > below or 2 * (part - got) > words[k]):
            got, k = int(upto[k]), k + 1
        left -= got
        stop = k < len(words) and left > below
        cut = int(least[k]) if k < len(words) else int(most[-1]) + 1
        out.append((pdf["_set"].iloc[0], c, cut, int(most[k]) if stop else -1, part - got, left))
        if stop:
            break
    return pd.DataFrame(out, columns=[f.split()[0] for f in _WALKED.split(", ")])


def _swap(pdf):
    """The open document to take and the taken one to leave that bring ``rest`` nearest to 0; one of them may be missing."""
    rest, sides = int(pdf["rest"].iloc[0]), []
    for taken in (False, True):
        rows = pdf[pdf["taken"] == taken].sort_values("size")
        sides.append((rows, np.concatenate([[0], rows["size"].to_numpy()]).astype(np.int64)))
    (_, add), (_, drop) = sides
    near = np.searchsorted(drop, add - rest)
    near = np.stack([np.maximum(near - 1, 0), np.minimum(near, len(drop) - 1)])
    off = np.abs(rest - add + drop[near])
    side, b = np.unravel_index(np.argmin(off), off.shape)
    chosen = (b, near[side, b]) if off[side, b] < abs(rest) else (0, 0)
    found = [rows.iloc[i - 1 : i] for (rows, _), i in zip(sides, chosen, strict=True) if i]
    return pd.concat(found or [pdf.iloc[:0]])[["_set", "_class", "_at", "taken"]]


def _cuts(sized: DataFrame, classes: dict[str, dict[int, int]], more: dict[str, int]) -> dict[tuple[str, int], tuple]:
    """By set and class: documents before the first number are taken, and those in the first list, without the second.

    ``classes`` holds the words of each set by class, ``more`` what each set has to give.
    """
    spark = sized.sparkSession
    sized = sized.filter("size > 0").select("_set", "_class", "_at", "size")
    unit = [F.sum("size").alias("words"), F.min("_at").alias("least"), F.max("_at").alias("most")]
    units = sized.groupBy("_set", "_class", F.shiftright("_at", _UNIT_BITS).alias("_unit")).agg(*unit)
    units = materialise(units.select("_set", "_class", "words", "least", "most"), "units")
    cuts: dict[tuple[str, int], tuple[int, list[int], list[int]]] = {}
    rests = []
    below = {(p, c): sum(n for d, n in own.items() if d < c) for p, own in classes.items() for c in own}
    # the classes below ``top`` are open; within ``top`` a unit may be, with its part
    open_ = [(p, 99, left, -1, -1, -1) for p, left in more.items() if left > 0]
    while open_:
        asked = F.broadcast(spark.createDataFrame(open_, "_set string, top int, left long, part long, first long, last long"))
        rows = units.join(asked, "_set").filter("_class < top").select(units.columns + ["left", F.lit(-1).cast("long").alias("part")])
        if any(part >= 0 for *_, part, _, _ in open_):
            inner = sized.join(asked.filter("part >= 0").withColumnRenamed("top", "_class"), ["_set", "_class"])
            inner = inner.filter("_at between first and last")
            step = F.expr(f"(_at - first) div ((last - first) div {_UNITS} + 1)").alias("_unit")
            inner = inner.groupBy("_set", "_class", "left", "part", step).agg(*unit)
            rows = rows.unionByName(inner.drop("_unit"))
        walked = rows.groupBy("_set").applyInPandas(_walk, _WALKED).collect()
        open_, near = [], {}
        for r in walked:
            cuts[r["_set"], r["_class"]] = (r.cut, [], [])
            if r.most > r.cut:
                open_.append((r["_set"], r["_class"], r.left, r.part, r.cut, r.most))
            elif r.most == r.cut:
                near[r["_set"]] = (r["_class"], r.left)
        # a single document is next and the smaller classes cannot hold what is left: the document that leaves least
        while near:
            table = [(p, c, left, below[p, c], *cuts[p, c][:2]) for p, (c, left) in near.items()]
            asked = spark.createDataFrame(table, "_set string, _class int, left long, below long, cut long, also array<long>")
            found = sized.join(F.broadcast(asked), ["_set", "_class"]).filter("_at >= cut and not array_contains(also, _at)")
            found = found.groupBy("_set", "left", "below", "_at").agg(F.sum("size").alias("size"))
            off = F.expr("greatest(size - left, 0L) + greatest(left - size - below, 0L)")
            found = found.groupBy("_set").agg(F.min(F.struct(off.alias("off"), "_at", "size")).alias("best"))
            best, asked_of, near = {r["_set"]: r.best for r in found.collect()}, near, {}
            for p, (c, left) in asked_of.items():
                if p in best and best[p].off < left - below[p, c]:
                    cuts[p, c][1].append(best[p]["_at"])
                    left -= best[p]["size"]
                    if left > below[p, c]:
                        near[p] = (c, left)
                    elif left > 0:
                        open_.append((p, c, left, -1, -1, -1))
                    elif left < 0:
                        rests.append((p, c, left))
                else:
                    cuts.update({(p, d): (_ALL, [], []) for d in classes[p] if d < c})
                    rests.append((p, c, left - below[p, c]))
    if rests:
        asked = [(p, d, rest, *cuts.get((p, d), _NONE)[:2]) for p, c, rest in rests for d in classes[p] if d <= c]
        asked = spark.createDataFrame(asked, "_set string, _class int, rest long, cut long, also array<long>")
        found = sized.join(F.broadcast(asked), ["_set", "_class"])
        found = found.withColumn("taken", F.expr("_at < cut or array_contains(also, _at)"))
        found = found.groupBy("_set", "_class", "_at", "taken", "rest").agg(F.sum("size").alias("size"))
        found = found.groupBy("_set", "taken", "rest", "size").agg(F.min(F.struct("_class", "_at")).alias("least"))
        found = found.select("_set", "taken", "rest", "size", "least.*")
        for r in found.groupBy("_set").applyInPandas(_swap, _SWAPS).collect():
            own = cuts.setdefault((r["_set"], r["_class"]), (0, [], []))
            own[2 if r.taken else 1].append(r["_at"])
    return cuts


def _members(column: Column, kind: str) -> Column:
    names = column if kind.startswith("array") else F.array(column)
    return F.coalesce(F.array_sort(F.array_distinct(names)), F.array(F.lit(None).cast("string")))


def mix(
    docs: DataFrame, source_column: str = "source", id_column: str = "doc_id", text_column: str = "text",
    weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, copies: int = COPIES, seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """(documents, sources). Documents: struct ``row`` with all columns, ``size`` in words, ``sources`` (its sorted
    sources), ``repeats`` and ``taken`` (repeats times size). Sources: source, source_size, target.

    ``source_column`` is one source or an array of them; null, or an empty array, is a source of its own, the last.
    Sources in code point order weigh ``weights`` in turn and share ``share`` of all words; a target stops at
    ``copies`` times its source's size. A null text has no words. Rows with equal id and text are taken alike. A
    document without words is repeated like its set's smallest documents. Without rows both results are empty.
    """
    spark, kind = docs.sparkSession, dict(docs.dtypes)[source_column]
    size = F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("long")
    sources = F.filter(_members(F.col(source_column), kind), lambda s: F.lit(True))
    sources = F.when(F.size(sources) == 0, F.array(F.lit(None).cast("string"))).otherwise(sources)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        size.alias("size"),
        sources.alias("sources"),
        F.xxhash64(F.lit(seed), id_column, text_column).alias("h"),
    )
    keyed = lambda df: df.withColumns(
        {
            "_set": F.to_json("sources", {"ignoreNullFields": "false"}),
            "_class": F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int"),
            "_at": F.shiftrightunsigned("h", 2),
        }
    )
    sized = materialise(keyed(rows).select("size", "sources", "_set", "_class", "_at"), "sized")

    classes = sized.groupBy("_set", "_class").agg(F.sum("size").alias("words"), F.first("sources").alias("sources")).collect()
    capacity: dict[tuple, int] = {}
    names = {}
    for r in classes:
        names[r["_set"]] = tuple(r.sources)
        capacity[tuple(r.sources)] = capacity.get(tuple(r.sources), 0) + r.words
    known = sorted({s for p in capacity for s in p}, key=lambda s: (s is None, "" if s is None else s))
    sizes = {s: sum(n for p, n in capacity.items() if s in p) for s in known}
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(known)}
    goal = targets(sizes, weigh, share * sum(capacity.values()), copies)
    flow = route(capacity, {s: int(goal[s]) for s in known}, copies)

    # per set: whole repeats of all, and the words that one more copy of some has to give
    whole, more, words = {}, {}, {}
    for p, sources_of in names.items():
        give, n = sum(flow[sources_of].values()), capacity[sources_of]
        whole[p] = min(give // n, copies) if n else 0
        more[p] = give - whole[p] * n
    for r in classes:
        if r.words:
            words.setdefault(r["_set"], {})[r["_class"]] = r.words
    cuts = _cuts(sized, words, more)
    rule = [(r["_set"], r["_class"], int(whole[r["_set"]]), *cuts.get((r["_set"], r["_class"]), _NONE)) for r in classes]
    fields = "_set string, _class int, whole long, cut long, also array<long>, less array<long>"
    rule = materialise(spark.createDataFrame(rule, fields), "rule")

    extra = F.expr("(_at < cut or array_contains(also, _at)) and not array_contains(less, _at)")
    found = keyed(rows).join(broadcast_if_small(rule), ["_set", "_class"]).withColumn("repeats", (F.col("whole") + extra.cast("int")).cast("int"))
    found = found.select("row", "size", "sources", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))
    table = [(s, sizes[s], float(goal[s])) for s in known]
    return found, spark.createDataFrame(table, "source string, source_size long, target double")
