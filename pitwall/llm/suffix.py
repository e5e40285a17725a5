"""Removal of passages that an earlier document holds, by longest previous factors in suffix order.

A byte goes if a ``match``-byte string that covers it also starts in a document with a smaller id; strings are judged
on the input. Only strings that can repeat are ever brought together:

1. Every ``match``-byte string names an anchor, the lowest hash among its ``gram``-byte substrings, so equal strings
   name equal anchors. The strings that share an anchor form one stretch of text. Hashes of anchors and stretches are
   packed and dealt out by anchor. A stretch that an earlier document holds too is covered as a whole. A string has
   half of its bytes beside the anchor on the left of it or on the right, so another stretch can share one only if it
   shares a half of these: such a stretch has to be looked at. All others are done, also those that meet at their
   anchor by chance, as ever more do in a growing input.
2. The bytes of the stretches to be looked at are dealt out by anchor. A bucket sorts the suffixes at its strings to a
   depth of ``match`` bytes, takes the common prefixes of neighbours, and finds the previous and next suffix of a
   smaller document. The longer common prefix with these two is the longest previous factor; one of ``match`` bytes is
   a later copy.
3. The spans found are joined to the texts and cut out.

Skew: tasks reduce equal stretches before the shuffle. An anchor with many different surroundings (the ends of a
very common line) is dealt out by stretch, and in step 2 by single strings, which are reduced in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.arrays import _BASE, U64, Sums, byte_values, flat, giving_back, giving_back_group, lists, mix, slices
from pitwall.llm.packs import arrow_schema, bytes_of, least, runs, values_of
from pitwall.session import materialise

MATCH = 50
GRAM = 16
# Anchors that a task gathers before it packs them.
PACK = 1 << 19
# Anchors of a bucket that are judged at a time, in some 150 bytes each.
JUDGED = 1 << 18
# Bytes of input for each bucket of packed anchors, and of stretches.
ANCHOR_BUCKET = 22 << 20
TEXT_BUCKET = 6 << 20
# Different stretches of one anchor that a task sends, and that a bucket compares, before they are dealt out finer.
SPREAD = 64
HOT = 4096
NO_ID = np.iinfo(np.int64).max
_LOW40, _LOW48 = U64((1 << 40) - 1), U64((1 << 48) - 1)

_PACKED = "bucket long, done boolean, h binary, g binary, half binary, ids binary, keys binary, counts binary"
_ANSWERS = "key long, covered array<long>, look array<long>, hot array<long>"
_STRETCHES = "bucket long, key long, id long, at long, size long, stretch binary"
_SPANS = "key long, start long, stop long"


def _half_hashes(sums: Sums, at, first, last, match: int, gram: int) -> np.ndarray:
    """16 bits each, 0 for none, of an anchor with half of the bytes beside it in a string, on the left and on the right.

    A string with fewer bytes than that half on the left has the rest, and so the other half, on the right.
    """
    left = (match - gram + 1) // 2
    right = match - gram - left + 1

    def of(start, stop, known):
        found = np.zeros(len(at), np.uint64)
        found[known] = sums.hashes(start[known], stop[known]) % U64(0xFFFF) + U64(1)
        return found

    return of(at - left, at + gram, at - first >= left) | of(at, at + gram + right, at - last < left) << U64(16)


def anchors(data, offsets, match=MATCH, gram=GRAM, halves=False):
    """Row, first and last string, anchor hash and stretch hash of each stretch of strings with one anchor, and half hashes."""
    n, none = len(data), np.zeros(0, np.int64)
    if n < match:
        return (none, none, none, *(none.astype(U64),) * (3 if halves else 2))
    values = byte_values(lower=False)[data]
    h, size = values, 1
    while size < gram:
        left = h[:-size] * U64(pow(int(_BASE), size, 1 << 64))
        left += h[size:]
        h, size = left, size * 2
    # 32 bits of the hash above the position: the minimum is the leftmost of equals
    low = h * U64(0xFF51AFD7ED558CCD)
    low &= U64(0xFFFFFFFF00000000)
    low |= np.arange(len(h), dtype=np.uint64)
    size, span = 1, match - gram + 1
    while size < span:
        step = min(size, span - size)
        low, size = np.minimum(low[:-step], low[step:]), size + step
    at = (low & U64(0xFFFFFFFF)).astype(np.int64)
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)[: len(at)]
    inside = np.arange(len(at)) + match <= offsets[1:][row]
    change = np.ones(len(at), bool)
    change[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    stop = np.ones(len(at), bool)
    stop[:-1] = change[1:] | ~inside[1:]
    first, last = np.flatnonzero(change & inside), np.flatnonzero(stop & inside)
    sums = Sums(values)
    found = row[first], first, last, mix(h[at[first]]) & _LOW40, sums.hashes(first, last + match) & _LOW48
    return (*found, _half_hashes(sums, at[first], first, last, match, gram)) if halves else found


def _binary(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.BinaryArray:
    """Substrings of a byte array as a column."""
    sizes = stop - start
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data[at])])


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_id").to_numpy(zero_copy_only=False)


def _pack(bucket, done, row, h, g, half, ids, keys) -> Iterator[dict]:
    """One packed record per bucket; rows of a document stand together."""
    if not len(bucket):
        return
    order = np.lexsort((row, bucket))
    bucket, row, h, g, half = bucket[order], row[order], h[order], g[order], half[order]
    starts = np.flatnonzero(runs(bucket))
    for a, b in zip(starts, [*starts[1:], len(bucket)], strict=True):
        docs, counts = np.unique(row[a:b], return_counts=True)
        yield {
            "bucket": int(bucket[a]), "done": done, "h": bytes_of(h[a:b], 5), "g": bytes_of(g[a:b], 6), "half": bytes_of(half[a:b], 4),
            "ids": ids[docs].tobytes(), "keys": keys[docs].tobytes(), "counts": counts.astype(np.int32).tobytes(),
        }


def _deal_anchors(buckets: int, match: int, gram: int, schema: pa.Schema):
    def packed(row, h, g, half, ids, keys):
        order = np.lexsort((g, h))
        row, h, g, half = row[order], h[order], g[order], half[order]
        new = runs(h, g)
        later = ids[row] > least(ids[row], new)
        # different stretches of an anchor: beyond a limit they go to buckets by stretch, and the anchor is marked
        new_h = runs(h)
        begin = np.flatnonzero(new_h)
        many = (np.add.reduceat(new.astype(np.int64), begin) > SPREAD)[np.cumsum(new_h) - 1] if len(h) else new_h
        bucket = (h % U64(buckets)).astype(np.int64)
        spread = (buckets + (g % U64(buckets)).astype(np.int64)) * many + bucket * ~many
        keep = ~later
        yield from _pack(spread[keep], False, row[keep], h[keep], g[keep], half[keep], ids, keys)
        mark = many & new_h
        yield from _pack(bucket[mark], None, row[mark], h[mark], g[mark], half[mark], ids, keys)
        if later.any():
            yield from _pack(2 * buckets + bucket[later], True, row[later], h[later], g[later], half[later], ids, keys)

    def run(batches):
        held, size, docs = [], 0, 0

        def flush():
            parts = [np.concatenate(x) for x in zip(*held, strict=True)]
            for record in packed(*parts):
                yield pa.RecordBatch.from_pylist([record], schema)

        for batch in slices(batches, "_text"):
            row, _, _, h, g, half = anchors(*flat(batch.column("_text")), match, gram, halves=True)
            held.append((row + docs, h, g, half, _ids(batch), batch.column("_key").to_numpy(zero_copy_only=False)))
            size, docs = size + len(row), docs + batch.num_rows
            if size >= PACK:
                yield from flush()
                held, size, docs = [], 0, 0
        if size:
            yield from flush()

    return run


def _of_several_documents(h: np.ndarray, half: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which rows have a half hash that rows of another document have at the same anchor too."""
    found = np.zeros(len(h), bool)
    order = np.lexsort((half, h))
    order = order[half[order] > 0]
    if len(order):
        begin = np.flatnonzero(runs(h[order], half[order]))
        several = np.minimum.reduceat(ids[order], begin) != np.maximum.reduceat(ids[order], begin)
        found[order] = np.repeat(several, np.diff(np.append(begin, len(order))))
    return found


def _judge_anchors(buckets: int, hot: int, schema: pa.Schema):
    """Per document of a bucket: stretches that are covered, that have to be looked at, and those of hot anchors."""

    def judged(rows: list[dict], part: int, parts: int) -> list[np.ndarray]:
        """Of the anchors whose upper hash bits give ``part``, so that equal ones stand together: keys, stretches, verdicts."""
        held = []
        for r in rows:
            h, counts = values_of(r["h"], 5), np.frombuffer(r["counts"], np.int32)
            own = np.flatnonzero((h >> U64(32)) % U64(parts) == part)
            ids, keys = (np.repeat(np.frombuffer(r[name], np.int64), counts)[own] for name in ("ids", "keys"))
            kind = (r["done"] is True, r["done"] is None, buckets <= r["bucket"] < 2 * buckets)
            g, half = values_of(r["g"], 6)[own], values_of(r["half"], 4)[own].astype(np.uint32)
            held.append((h[own], g, half, ids, keys, *(np.full(len(own), k) for k in kind)))
        h, g, half, ids, keys, done, mark, spread = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        if not len(h):
            return [keys, g.astype(np.int64), done, done, done]
        order = np.lexsort((g, h))
        h, g, half, ids, keys, done, mark, spread = (x[order] for x in (h, g, half, ids, keys, done, mark, spread))
        new_h, new = runs(h), runs(h, g)
        run_of, begin = np.cumsum(new_h) - 1, np.flatnonzero(new_h)
        marked = np.logical_or.reduceat(mark | spread, begin)[run_of]
        # a mark stands for stretches elsewhere: it neither covers nor is covered
        covered = done | ~mark & (ids > least(np.where(mark, NO_ID, ids), new))
        open_ = ~mark & ~covered
        # of equal stretches those of one document are left here, so two documents mean two stretches
        at = np.flatnonzero(open_ & ~marked)
        halves = [_of_several_documents(h[at], half[at] >> np.uint32(k) & np.uint32(0xFFFF), ids[at]) for k in (0, 16)]
        look = open_ & marked
        look[at[halves[0] | halves[1]]] = True
        different = np.bincount(run_of[look], runs(run_of[look], g[look]), len(begin))[run_of]
        in_hot = look & (marked | (different > hot))
        out = np.flatnonzero(covered | look)
        return [keys[out], g[out].astype(np.int64), covered[out], (look & ~in_hot)[out], in_hot[out]]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = min(256, 1 + sum(len(r["h"]) for r in rows) // 5 // JUDGED)
        keys, g, *verdicts = map(np.concatenate, zip(*(judged(rows, part, parts) for part in range(parts)), strict=True))
        order = np.argsort(keys, kind="stable")
        keys, g = keys[order], g[order]
        starts = np.flatnonzero(runs(keys)) if len(keys) else np.zeros(0, np.int64)
        columns = [pa.array(keys[starts])]
        for mask in (verdict[order] for verdict in verdicts):
            counts = np.add.reduceat(mask.astype(np.int64), starts) if len(starts) else starts
            columns.append(lists(g[mask], counts))
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _deal_stretches(buckets: int, match: int, gram: int, schema: pa.Schema):
    """Covered stretches as spans without bytes, in buckets below zero; the others with their bytes."""

    def rows(bucket, key, ids, at, size, column=None):
        if column is None:
            column = pa.nulls(len(key), pa.binary())
        numbers = (bucket, key, ids, at, size)
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in numbers] + [column], schema=schema)

    def spans(key, at, size):
        return rows(-1 - key % buckets, key, key, at, size)

    def hot_strings(held):
        """Equal strings of a task meet here: the first document's goes on, the others are covered."""
        hashes, key, ids, at, texts = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((ids, hashes))
        new = runs(hashes[order])
        later = np.zeros(len(order), bool)
        later[order] = ids[order] > least(ids[order], new)
        yield spans(key[later], at[later], np.full(later.sum(), match))
        own = ~later
        data = np.ascontiguousarray(texts[own]).view(np.uint8)
        begin = np.arange(0, len(data), match)
        column = _binary(data, begin, begin + match)
        yield rows(hashes[own] % U64(buckets), key[own], ids[own], at[own], np.full(own.sum(), match), column)

    def run(batches):
        held, size = [], 0
        for batch in slices(batches, "_text"):
            data, offsets = flat(batch.column("_text"))
            row, first, last, h, g = anchors(data, offsets, match, gram)
            stop = last + match
            here = row.astype(np.uint64) << U64(48) | g
            key, ids = batch.column("_key").to_numpy(zero_copy_only=False)[row], _ids(batch)[row]
            base = offsets[row]

            def named(column, batch=batch, here=here):
                column = batch.column(column)
                wanted = np.repeat(np.arange(batch.num_rows, dtype=np.uint64) << U64(48), np.diff(column.offsets.to_numpy()))
                return np.isin(here, wanted | column.flatten().to_numpy().astype(np.uint64))

            hit = np.flatnonzero(named("covered"))
            if len(hit):
                new = np.ones(len(hit), bool)
                new[1:] = (row[hit][1:] != row[hit][:-1]) | (first[hit][1:] > stop[hit][:-1])
                begin = hit[new]
                end = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)]
                yield spans(key[begin], first[begin] - base[begin], stop[end] - first[begin])
            hit = named("look")
            a, b = first[hit], stop[hit]
            yield rows((h[hit] >> U64(8)) % U64(buckets), key[hit], ids[hit], a - base[hit], b - a, _binary(data, a, b))
            hit = named("hot")
            if hit.any():
                many = (last - first + 1)[hit]
                a = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[hit], many)
                hashes = Sums(byte_values(lower=False)[data]).hashes(a, a + match)
                texts = np.lib.stride_tricks.sliding_window_view(data, match)[a].view(f"V{match}").ravel()
                held.append((hashes, *(np.repeat(x[hit], many) for x in (key, ids)), a - np.repeat(base[hit], many), texts))
                size += len(a)
                if size >= PACK // 4:
                    yield from hot_strings(held)
                    held, size = [], 0
        if held:
            yield from hot_strings(held)

    return run


def _words(data: np.ndarray, start: np.ndarray, depth: int) -> list[np.ndarray]:
    """The first ``depth`` bytes of each suffix as big-endian numbers; the last one overlaps the one before."""
    big = np.zeros(len(data), np.uint64)
    for k in range(8):
        big[: len(data) - k] |= data[k:].astype(np.uint64) << U64(56 - 8 * k)
    return [big[start + k] for k in (*range(0, depth - 8, 8), depth - 8)]


def suffix_array(words: list[np.ndarray]) -> np.ndarray:
    """The order of the suffixes by their first bytes; equal ones stay as they are."""
    return np.lexsort(words[::-1])


def common_prefixes(words: list[np.ndarray], order: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes, up to ``depth``, each suffix in order shares with the one before; 0 for the first."""
    n = len(order)
    lcp, same = np.zeros(n, np.int64), np.ones(n, bool)
    same[:1] = False
    done = 0
    for k, word in enumerate(words):
        skip = done - (depth - 8 if k == len(words) - 1 else 8 * k)  # bytes that the word before has shown
        ranked = word[order]
        differ = np.zeros(n, np.uint64)
        differ[1:] = ranked[1:] ^ ranked[:-1]
        equal = (differ[:, None] < (U64(1) << np.arange(0, 64, 8, dtype=np.uint64))).sum(axis=1)
        lcp += np.where(same, equal - skip, 0)
        same &= differ == 0
        done += 8 - skip
    return lcp


def nearest_smaller(ids: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the last one before it with a smaller id (-1: none), and the common prefix of the two.

    All places jump at once: where the place before has no smaller id, that place's own candidate is next, as all
    between have no smaller id either.
    """
    before, shared = np.arange(len(ids)) - 1, lcp.copy()
    todo = np.flatnonzero(before >= 0)
    while len(todo):
        todo = todo[ids[before[todo]] >= ids[todo]]
        at = before[todo]
        shared[todo] = np.minimum(shared[todo], shared[at])
        before[todo] = before[at]
        todo = todo[before[todo] >= 0]
    shared[before < 0] = 0
    return before, shared


def longest_previous_factors(ids: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """By place in suffix order: the longest prefix, up to the depth, that also starts in a document with a smaller id."""
    _, up = nearest_smaller(ids, lcp)
    # from the other end: the common prefix with the next place is that of the next place with this one
    turned = np.zeros(len(lcp), np.int64)
    turned[1:] = lcp[:0:-1]
    _, down = nearest_smaller(ids[::-1], turned)
    return np.maximum(up, down[::-1])


def later_copies(data: np.ndarray, start: np.ndarray, ids: np.ndarray, match: int) -> np.ndarray:
    """Which of the ``match``-byte strings at ``start`` also begin in a document with a smaller id.

    Strings whose hash occurs in one document only cannot. The others' suffixes are sorted to a depth of ``match``
    bytes, and those whose longest previous factor has that length are later copies.
    """
    hashes = Sums(byte_values(lower=False)[data]).hashes(start, start + match)
    order = np.argsort(hashes)
    new = runs(hashes[order])
    found = np.zeros(len(start), bool)
    begin = np.flatnonzero(new)
    low, high = (f.reduceat(ids[order], begin) for f in (np.minimum, np.maximum))
    some = order[(low != high)[np.cumsum(new) - 1]]
    if not len(some):
        return found
    words = _words(data, start[some], match)
    ranked = suffix_array(words)
    factors = longest_previous_factors(ids[some][ranked], common_prefixes(words, ranked, match))
    found[some[ranked]] = factors >= match
    return found


def _suffix_spans(match: int, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        key, ids, at, size = (table.column(c).to_numpy() for c in ("key", "id", "at", "size"))
        if table.column("bucket")[0].as_py() < 0:
            return pa.Table.from_arrays([pa.array(key), pa.array(at), pa.array(at + size)], schema=schema)
        data, offsets = flat(table.column("stretch").combine_chunks())
        many = size - match + 1
        owner = np.repeat(np.arange(len(size)), many)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + offsets[owner]
        hit = later_copies(data, start, ids[owner], match)
        start, owner = start[hit], owner[hit]
        new = np.ones(len(start), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] - start[:-1] > match)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(start))[: len(begin)] - 1
        own, shift = owner[begin], (at - offsets[:-1])[owner[begin]]
        columns = key[own], start[begin] + shift, start[end] + match + shift
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=schema)

    return run


def _cut(schema: pa.Schema):
    """Take the spans out of the texts."""

    def run(batches):
        for batch in slices(batches, "_text"):
            data, offsets = flat(batch.column("_text"))
            start, stop = batch.column("_start"), batch.column("_stop")
            base = np.repeat(offsets[:-1], np.diff(start.offsets.to_numpy()))
            change = np.zeros(len(data) + 1, np.int64)
            np.add.at(change, base + start.flatten().to_numpy(), 1)
            np.add.at(change, base + stop.flatten().to_numpy(), -1)
            gone = np.cumsum(change)[:-1] > 0
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            inner = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(data))]
            edge[inner] = gone[inner]
            per_row = lambda mask: np.diff(np.append(0, np.cumsum(mask))[offsets])
            removed = per_row(gone)
            kept_at = np.append(0, np.cumsum(~gone))[offsets]
            kept = _binary(data[~gone], kept_at[:-1], kept_at[1:])
            columns = [batch.column("_rest"), kept, np.diff(offsets), removed, per_row(edge)]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    return run


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", match: int = MATCH, gram: int = GRAM
) -> DataFrame:
    """All columns of ``docs`` but the text in struct ``row``, with ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed`` and
    ``n_spans`` (longest runs of removed bytes).

    A null text is empty. Texts shorter than ``match`` bytes keep everything. Rows with equal ids never cover each
    other; a row without an id counts as the last, so it covers none and is covered by all others. Repeated rows are
    judged alike. Texts are bytes: a cut can fall inside a character.
    """
    if not 8 <= gram <= match or gram & (gram - 1):
        raise ValueError("gram must be a power of two from 8 to match")
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit("").cast("binary"))
    rest = F.struct(*(c for c in docs.columns if c != text_column))
    rows = docs.select(
        rest.alias("_rest"),
        F.coalesce(F.col(id_column), F.lit(NO_ID)).cast("long").alias("_id"),
        text.alias("_text"),
    ).withColumn("_key", F.xxhash64("_id", "_text"))
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    packs, parts = size // ANCHOR_BUCKET + 4, size // TEXT_BUCKET + 8

    packed = rows.select("_key", "_id", "_text").mapInArrow(giving_back(_deal_anchors(packs, match, gram, arrow_schema(_PACKED))), _PACKED)
    judged = packed.groupBy("bucket").applyInArrow(giving_back_group(_judge_anchors(packs, HOT, arrow_schema(_ANSWERS))), _ANSWERS)
    # the spans need the texts' shuffle again, so both joins stand in one query; the answers are written once
    answers = materialise(judged, "anchors")
    answers = answers.groupBy(F.col("key").alias("_key")).agg(
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("covered", "look", "hot"))
    )
    stretches = rows.join(answers, "_key").mapInArrow(
        giving_back(_deal_stretches(parts, match, gram, arrow_schema(_STRETCHES))), _STRETCHES
    )
    spans = stretches.groupBy("bucket").applyInArrow(giving_back_group(_suffix_spans(match, arrow_schema(_SPANS))), _SPANS)
    spans = spans.groupBy(F.col("key").alias("_key")).agg(
        F.collect_list("start").alias("_start"), F.collect_list("stop").alias("_stop")
    )
    none = F.array().cast("array<long>")
    joined = rows.join(spans, "_key", "left").withColumns(
        {c: F.coalesce(F.col(c), none) for c in ("_start", "_stop")}
    )
    out = docs.select(rest.alias("row")).schema
    out = out.add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    return joined.mapInArrow(giving_back(_cut(arrow_schema(out))), out)
