"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of the last 0 to 3 bytes with the counts of the byte that follows. A byte seen n of
N times in the longest context costs -log2(n / (N + d)) bits, with d different bytes seen there; an unseen one pays
the escape -log2(d / (N + d)) and goes on in the next shorter context, down to all 256 bytes alike. A context that
never occurred costs nothing to leave. The statistics are frozen after fitting, so the code length of a text is a sum
over its positions, exact and the same wherever it is computed. The language with the shortest code wins.

Fitting takes up to ``per_language`` texts of each language, those of the least hashed ids, so the tables are bounded
by that sample. Long texts are coded in pieces that see the three bytes before them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.llm.arrays import flat, giving_back, slices
from pitwall.llm.packs import arrow_schema
from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

PER_LANGUAGE = 400
ORDER = 3
# Positions that are coded at once.
PIECE = 1 << 18
# How many times as many rows as a sample needs pass the bound on hashed ids.
SPARE = 4
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where keys stand among sorted ones, and whether they do."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


@dataclass
class Model:
    """Bits by language. ``grams[i]`` are the sorted seen strings of i + 1 bytes as numbers and ``bits[i]`` what their
    last byte costs after the others, a row per string; all bytes and pairs of bytes have rows. ``contexts[i]`` and
    ``escapes[i]`` are the seen contexts of i bytes and what leaving them costs."""

    languages: list[str]
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def costs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Bits of the last byte of each string of ``order`` + 1 bytes."""
        if order <= 1:
            return self.bits[order][keys]
        at, seen = _find(self.grams[order], keys)
        cost = self.bits[order][at]
        rest = np.flatnonzero(~seen)
        if len(rest):
            width = 8 * order
            cost[rest] = self.costs(keys[rest] & np.uint32((1 << width) - 1), order - 1)
            left, known = _find(self.contexts[order], keys[rest] >> np.uint32(8))
            cost[rest] += np.where(known[:, None], self.escapes[order][left], 0)
        return cost

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each row in each language; a text starts as after three spaces."""
        rows, lengths = len(offsets) - 1, np.diff(offsets)
        out = np.zeros((rows, len(self.languages)))
        row = np.repeat(np.arange(rows), lengths)
        for start in range(0, len(data), PIECE):
            stop = min(start + PIECE, len(data))
            here = np.arange(start, stop)
            since, keys = here - offsets[row[start:stop]], data[start:stop].astype(np.uint32)
            for back in range(1, ORDER + 1):
                before = np.where(since >= back, data[np.maximum(here - back, 0)], 32).astype(np.uint32)
                keys |= before << np.uint32(8 * back)
            cost = self.costs(keys)
            first, last = row[start], row[stop - 1]
            for k in range(len(self.languages)):
                out[first : last + 1, k] += np.bincount(row[start:stop] - first, cost[:, k], last - first + 1)
        return out


def _counts(schema: pa.Schema):
    """Counts of strings of four bytes by language, reduced per piece."""

    def run(batches):
        for batch in slices(batches, "text"):
            for language, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                b = np.frombuffer(b"   " + text.encode(), np.uint8)
                for start in range(0, len(b) - 3, PIECE):
                    w = b[start : start + PIECE + 3].astype(np.int64)
                    grams, n = np.unique(((w[:-3] << 8 | w[1:-2]) << 8 | w[2:-1]) << 8 | w[3:], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([language] * len(n)), pa.array(grams), pa.array(n)], schema=schema)

    return run


def _sample(known: DataFrame, per_language: int) -> DataFrame:
    """(doc_id, lang) of the least hashed ids of each language.

    Ids beyond a bound on the hash, a few times what the sample needs, are left out before they are ranked.
    """
    many = materialise(known.groupBy("lang").agg(F.count("*").alias("_many")), "languages")
    hashed = F.xxhash64("doc_id").cast("double") / float(1 << 63)
    bound = SPARE * per_language * 2.0 / F.col("_many") - 1
    near = known.select("doc_id", "lang").join(broadcast_if_small(many), "lang").filter(hashed <= bound).select("doc_id", "lang")
    near = materialise(near, "least_hashed")
    short = near.groupBy("lang").agg(F.count("*").alias("_near")).join(many, "lang", "right")
    if not short.filter(F.coalesce("_near", F.lit(0)) < F.least("_many", F.lit(per_language))).isEmpty():
        near = known.select("doc_id", "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= per_language).select("doc_id", "lang").distinct()


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the languages in ``labelled`` (doc_id, text, lang); None without a text that has a language.

    Rows without text, letters or language are left out. Ties of the hashed id go to the smaller id.
    """
    known = labelled.filter("lang is not null and text is not null and doc_id is not null").filter(F.col("text").rlike(r"\p{L}"))
    chosen = materialise(_sample(known, per_language), "sample")
    texts = known.join(broadcast_if_small(chosen), ["doc_id", "lang"]).select("lang", "text")
    schema = "lang string, gram long, n long"
    counts = texts.mapInArrow(giving_back(_counts(arrow_schema(schema))), schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.orderBy("lang", "gram").toPandas()  # bounded by the sample
    if counts.empty:
        return None
    languages = sorted(counts.lang.unique())
    language = np.searchsorted(languages, counts.lang.to_numpy().astype(str))
    gram, n = counts.gram.to_numpy().astype(np.uint32), counts.n.to_numpy()
    model = Model(languages, [], [], [], [])
    for order in range(ORDER + 1):
        _add_order(model, order, gram, n, language)
    return model


def _add_order(model: Model, order: int, gram: np.ndarray, n: np.ndarray, language: np.ndarray) -> None:
    """The tables of contexts of ``order`` bytes, given those of the shorter ones."""
    mask = np.uint32((1 << 8 * (order + 1)) - 1)
    keys = np.arange(256 ** (order + 1), dtype=np.uint32) if order <= 1 else np.unique(gram & mask)
    contexts = np.unique(gram & mask) >> np.uint32(8) if order else np.zeros(1, np.uint32)
    contexts = np.unique(contexts)
    width = len(model.languages)
    bits, escapes = np.empty((len(keys), width), np.float32), np.zeros((len(contexts), width), np.float32)
    shorter = model.costs(keys & (mask >> np.uint32(8)), order - 1) if order else np.full((256, width), 8, np.float32)
    inside = np.searchsorted(contexts, keys >> np.uint32(8)) if order else np.zeros(len(keys), np.int64)
    has_context = inside < len(contexts)
    inside = np.minimum(inside, len(contexts) - 1)
    if order:
        has_context &= contexts[inside] == keys >> np.uint32(8)
    for k in range(width):
        own = language == k
        seen, back = np.unique(gram[own] & mask, return_inverse=True)
        times = np.bincount(back, n[own])
        before = seen >> np.uint32(8) if order else np.zeros(len(seen), np.uint32)
        context, first = np.unique(before, return_inverse=True)
        total, different = np.bincount(first, times), np.bincount(first)
        escapes[np.searchsorted(contexts, context), k] = -np.log2(different / (total + different))
        bits[:, k] = shorter[:, k] + np.where(has_context, escapes[inside, k], 0)
        at = np.searchsorted(keys, seen)
        bits[at, k] = -np.log2(times / (total + different)[first])
    model.grams.append(keys)
    model.bits.append(bits)
    model.contexts.append(contexts)
    model.escapes.append(escapes)


def identify(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """All columns of ``docs`` in struct ``row``, ``lang_pred`` and ``score``, the share of the best language in
    2 to the power of minus the code lengths.

    A text without a letter, empty or null, and every text without a model, is ``und`` with score 0. Ties go to the
    language that sorts first. Only the text is looked at.
    """
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_column).cast("string").alias("_text"))
    out = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    schema = arrow_schema(out)
    if model is None:
        return rows.select("row", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        own = sent.value
        languages = own.languages
        names = np.array([*languages, UNDETERMINED])
        letters = np.zeros(256, bool)
        letters[65:91] = letters[97:123] = True
        for batch in slices(batches, "_text"):
            data, offsets = flat(batch.column("_text"))
            bits = own.code_lengths(data, offsets)
            best = bits.argmin(axis=1)
            score = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            plain = np.diff(np.append(0, np.cumsum(letters[data]))[offsets]) > 0
            for i in np.flatnonzero(~plain):
                if not _LETTER.search(batch.column("_text")[i].as_py() or ""):
                    best[i], score[i] = len(languages), 0
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names[best].tolist()), pa.array(score)], schema=schema)

    return rows.mapInArrow(giving_back(run), out)
