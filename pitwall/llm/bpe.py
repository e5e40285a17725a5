"""Byte-level BPE by recursive SQL over token positions, one in-process DuckDB per task.

A task takes the different words of its texts (matches of the pattern); the most frequent words
of a bounded sample are encoded once and sent to all tasks. In a recursive query the token positions of each word join
the merge table, and each word contracts its pairs of least rank, leftmost first, until none is left. Between rounds
a word is one row with the text of its tokens; a long word is a row per token, as its text would be rewritten too often.
Several occurrences of a pair are contracted at once: a merged token takes part only in pairs of higher rank,
so the result is that of one pair at a time. Texts are their words' ids in order. Decoding joins ids to the vocabulary
and concatenates by position.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.llm.arrays import giving_back, slices
from pitwall.llm.packs import arrow_schema

# Bytes of words in one query, and rounds of one query; longer chains of merges go on in another.
QUERY_BYTES, ROUNDS = 1 << 21, 24
QUERY_WORDS = 30_000
# Bytes from which a word counts as long.
LONG_WORD = 48
# Bytes of texts whose words wait for one query.
HELD_BYTES = 16 << 20
# Words that a task remembers between its queries; beyond it forgets all and encodes them again.
REMEMBERED = 60_000
# Bytes of text in which frequent words are looked for, how many of them all tasks get, and the longest of them in
# bytes. Whether a word is among them changes nothing but the work.
SAMPLE_BYTES, FREQUENT, FREQUENT_BYTES = 32 << 20, 100_000, 24
_BATCH_BYTES = 1 << 22

# Tokens are written as characters from this one on, so that a word's tokens are a text and a pair is two characters.
FIRST_CHAR = 1 << 16
# A row is a word. Each round finds the least key of its pairs, which tells rank and place, and replaces that pair
# wherever it stands, from the left. Where different pairs that merge to the same token may overlap, the key is without
# the bit 2 ** 15 and the first of them alone is contracted.
_MERGE = f"""
with recursive step(round, word, tokens) as (
    select 0, word, tokens from start_words
    union all
    select round + 1, word, if(least & 32768 > 0, replace(tokens, substr(tokens, place, 2), merged),
                               substr(tokens, 1, place - 1) || merged || substr(tokens, place + 2))
    from (
        select round, word, any_value(tokens) as tokens, min(key + place) as least,
               min(key + place) & 32767 as place, chr(({FIRST_CHAR} + (min(key + place) >> 16))::int) as merged
        from (select *, unnest(range(1, length(tokens))) as place from step where round < {ROUNDS})
        join pairs on pair = substr(tokens, place, 2)
        group by round, word
    )
)
select word, arg_max(tokens, round) as tokens, max(round) as round from step group by word order by word
"""
# For long words: of each run of overlapping pairs every second one is cut, so that a run of n halves per round.
_MERGE_RUNS = f"""
with recursive step(round, word, pos, tok) as (
    select 0, word, pos, tok from start_tokens
    union all
    select round + 1, word, pos, if(cut, merged, tok)
    from (
        select *, lag(cut, 1, false) over (partition by word order by pos) as eaten
        from (
            select *, hit and row_number() over (partition by word, hit, island order by pos) % 2 = 1 as cut
            from (
                select *, merged is not distinct from least as hit,
                       sum(if(merged is not distinct from least, 0, 1)) over (partition by word order by pos) as island
                from (
                    select s.*, m.merged, min(m.merged) over (partition by word) as least
                    from (select *, lead(tok) over (partition by word order by pos) as next from step where round < {ROUNDS}) s
                    left join merges m on m.a = s.tok and m.b = s.next
                )
                where least is not null
            )
        )
    )
    where not eaten
)
select word, pos, tok, round from step
qualify round = max(round) over (partition by word)
order by word, pos
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken file: base64 and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _overlapping(pairs: list[tuple[int, int, int]]) -> set[int]:
    """Tokens that two different pairs make of which the second begins with the end of the first."""
    starts, ends = defaultdict(dict), defaultdict(dict)
    for a, b, merged in pairs:
        starts[merged][a], ends[merged][b] = b, a
    return {merged for merged, end in ends.items() for b, a in end.items() if b in starts[merged] and b != a}


class Codec:
    """The vocabulary and merge table of one DuckDB connection."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, frequent: pa.Table | None = None):
        import duckdb

        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        self.words = regex.compile(pattern)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:k]], ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        merges = pa.table(dict(zip(("a", "b", "merged"), (pa.array(c, pa.int32()) for c in zip(*pairs, strict=True)), strict=True)))
        self.chars = [chr(FIRST_CHAR + rank) for rank in self.byte.tolist()]
        one_by_one = _overlapping(pairs)
        keys = [(merged << 16) + (0 if merged in one_by_one else 32768) for _, _, merged in pairs]
        texts = pa.table({"pair": [chr(FIRST_CHAR + a) + chr(FIRST_CHAR + b) for a, b, _ in pairs], "key": pa.array(keys, pa.int64())})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "token": pa.array([t.hex() for t in ranks])})
        for name, table in (("merges", merges), ("pairs", texts), ("vocabulary", vocabulary)):
            self.db.register("given", table)
            self.db.execute(f"create table {name} as select * from given")
            self.db.unregister("given")
        # by number of a word: its ids joined by commas, how many, and the bytes that they decode to
        self.number: dict[str, int] = {}
        self.shown, self.size, self.raw = [], [], []
        if frequent is not None:
            words, self.shown, self.size, self.raw = (frequent.column(c).to_pylist() for c in ("word", "shown", "n", "raw"))
            self.number = dict(zip(words, range(len(words)), strict=True))
        self.kept = len(self.shown)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; many words share a query of bounded size."""
        raw = [word.encode() for word in words]
        out: list[list[int]] = [[]] * len(raw)
        for merge, chosen in (
            (self._merge, [i for i, r in enumerate(raw) if len(r) <= LONG_WORD]),
            (self._merge_long, [i for i, r in enumerate(raw) if len(r) > LONG_WORD]),
        ):
            part, size = [], 0
            for i in [*chosen, None]:
                if part and (i is None or size + len(raw[i]) > QUERY_BYTES):
                    for k, ids in zip(part, merge([raw[k] for k in part]), strict=True):
                        out[k] = ids
                    part, size = [], 0
                if i is not None:
                    part.append(i)
                    size += len(raw[i])
        return out

    def _merge(self, raw: list[bytes]) -> list[list[int]]:
        tokens, word = ["".join(map(self.chars.__getitem__, r)) for r in raw], list(range(len(raw)))
        given = tokens
        while word:
            self.db.register("start_words", pa.table({"word": pa.array(word, pa.int32()), "tokens": given}))
            rows = self.db.execute(_MERGE).fetchall()
            self.db.unregister("start_words")
            for k, text, _ in rows:
                tokens[k] = text
            word, given = [k for k, _, n in rows if n == ROUNDS], [text for _, text, n in rows if n == ROUNDS]
        ids = (np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32).astype(np.int32) - FIRST_CHAR).tolist()
        ends = np.cumsum([len(text) for text in tokens]).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_long(self, raw: list[bytes]) -> list[list[int]]:
        sizes = np.array([len(r) for r in raw])
        word = np.repeat(np.arange(len(raw)), sizes)
        tok = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        done_word, done_tok = [], []
        while len(word):
            self.db.register("start_tokens", pa.table({"word": word, "pos": np.arange(len(word)), "tok": tok}))
            found = self.db.execute(_MERGE_RUNS).fetchnumpy()
            self.db.unregister("start_tokens")
            word, tok = np.asarray(found["word"]), np.asarray(found["tok"])
            more = np.asarray(found["round"]) == ROUNDS
            done_word.append(word[~more])
            done_tok.append(tok[~more])
            word, tok = word[more], tok[more]
        word, tok = np.concatenate(done_word), np.concatenate(done_tok)
        order = np.argsort(word, kind="stable")
        return [part.tolist() for part in np.split(tok[order], np.cumsum(np.bincount(word, minlength=len(raw)))[:-1])]

    def numbers(self, text: str) -> np.ndarray:
        """The numbers of a text's words; new words get the next ones."""
        number = self.number
        return np.array([number.setdefault(w, len(number)) for w in self.words.findall(text)], np.int32)

    def pending(self) -> int:
        return len(self.number) - len(self.shown)

    def learn(self) -> None:
        """Encode and decode all words that are only numbered yet; many share a query, as each has a fixed cost."""
        new = list(islice(self.number, len(self.shown), None))
        for start in range(0, len(new), QUERY_WORDS):
            for shown, size, raw in self.results(new[start : start + QUERY_WORDS]):
                self.shown.append(shown)
                self.size.append(size)
                self.raw.append(raw)

    def forget(self) -> None:
        """Beyond a bound keep the frequent words only."""
        if len(self.shown) - self.kept > REMEMBERED:
            del self.shown[self.kept :], self.size[self.kept :], self.raw[self.kept :]
            self.number = dict(islice(self.number.items(), self.kept))

    def results(self, words: list[str]) -> Iterator[tuple[str, int, bytes]]:
        ids = self.encode_words(words)
        return zip((",".join(map(str, i)) for i in ids), map(len, ids), self.decode(ids), strict=True)

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids."""
        sizes = np.array([len(i) for i in ids], np.int64)
        row = np.repeat(np.arange(len(ids)), sizes)
        given = pa.table({"r": row, "pos": np.arange(len(row)), "id": np.concatenate([np.asarray(i, np.int64) for i in ids]) if len(row) else np.zeros(0, np.int64)})
        self.db.register("given", given)
        found = self.db.execute(
            "select r, string_agg(token, '' order by pos) as hex from given join vocabulary using (id) group by r"
        ).fetchall()
        self.db.unregister("given")
        out = [b""] * len(ids)
        for r, text in found:
            out[r] = bytes.fromhex(text)
        return out


def _codec(sent) -> Codec:
    """The codec of a worker process, held beside the vocabulary that it was sent: it serves all tasks there."""
    held = sent.value
    if "codec" not in held:
        held["codec"] = Codec(held["ranks"], held["pattern"], held.get("frequent"))
    return held["codec"]


def _counted(pattern: str, schema: pa.Schema):
    """How often each short word occurs, reduced per task."""

    def run(batches):
        find, found = regex.compile(pattern).findall, Counter()
        for batch in batches:
            for text in batch.column("_text").to_pylist():
                found.update(find(text))
        short = [(w, n) for w, n in found.items() if len(w.encode()) <= FREQUENT_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in short], pa.string()), pa.array([n for _, n in short], pa.int64())], schema=schema)

    return run


def _frequent_words(rows: DataFrame, path: str, pattern: str) -> pa.Table:
    """A bounded table of frequent words with their ids and bytes, for all tasks."""
    sent = _vocabulary(rows, path, pattern)
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    sample = rows.select("_text").sample(fraction=min(1.0, SAMPLE_BYTES / size) if size else 1.0, seed=7)
    counted = "word string, n long"
    words = sample.mapInArrow(giving_back(_counted(pattern, arrow_schema(counted))), counted).groupBy("word").agg(F.sum("n").alias("n"))
    words = words.filter("n > 1").orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").repartition(16)
    out = "word string, shown string, n long, raw binary"
    schema = arrow_schema(out)

    def encoded(batches):
        codec = _codec(sent)
        for batch in batches:
            here = batch.column("word").to_pylist()
            shown, n, raw = zip(*codec.results(here), strict=True) if here else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((here, shown, n, raw), schema.types, strict=True)], schema=schema)

    return words.mapInArrow(giving_back(encoded), out).toArrow()


def _vocabulary(docs: DataFrame, path: str, pattern: str, **more):
    """The vocabulary file, some megabytes of fixed size, read once by the driver."""
    return docs.sparkSession.sparkContext.broadcast({"ranks": read_ranks(path), "pattern": pattern, **more})


def _rows(docs: DataFrame, text_column: str) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_text"))


def encode(docs: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """Struct ``row`` with all columns of ``docs``, and ``ids``, the token ids of the whole text.

    A null or empty text has no ids. Special tokens' strings are ordinary text. Repeated rows are encoded alike.
    """
    sent, rows = _vocabulary(docs, path, pattern), _rows(docs, text_column)
    out = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = arrow_schema(out)

    def run(batches):
        codec = _codec(sent)
        for batch in slices(batches, "_text", _BATCH_BYTES):
            found = [codec.words.findall(t) for t in batch.column("_text").to_pylist()]
            here = list({w for words in found for w in words})
            known = dict(zip(here, codec.encode_words(here), strict=True))
            ids = [[i for w in words for i in known[w]] for words in found]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, schema.field("ids").type)], schema=schema)

    return rows.mapInArrow(giving_back(run), out)


def decode(tokens: DataFrame, path: str, pattern: str, ids_column: str = "ids") -> DataFrame:
    """All columns of ``tokens`` in struct ``row``, and ``decoded``, the bytes of its ids; null ids give none."""
    sent = _vocabulary(tokens, path, pattern)
    rows = tokens.select(F.struct(*tokens.columns).alias("row"), F.coalesce(F.col(ids_column), F.array().cast("array<int>")).alias("_ids"))
    out = rows.select("row").schema.add("decoded", "binary")
    schema = arrow_schema(out)

    def run(batches):
        codec = _codec(sent)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                ids = [np.asarray(x) for x in part.column("_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(codec.decode(ids), pa.binary())], schema=schema)

    return rows.mapInArrow(giving_back(run), out)


def round_trip(docs: DataFrame, path: str, pattern: str, text_column: str = "text") -> DataFrame:
    """Encode and decode in one pass: struct ``row``, ``n_tokens``, ``ids_sha256`` of the decimal ids joined by commas,
    ``decoded_sha256`` of the bytes that the ids decode to.

    Each different word's ids are decoded once per task; a text's bytes are its words' bytes in order.
    """
    rows = _rows(docs, text_column)
    sent = _vocabulary(docs, path, pattern, frequent=_frequent_words(rows, path, pattern))
    out = rows.select("row").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    schema = arrow_schema(out)

    def finish(codec, batch, held):
        columns = ([], [], [])
        for numbers in held:
            columns[0].append(sum(map(codec.size.__getitem__, numbers.tolist())))
            shown, raw = (map(part.__getitem__, numbers.tolist()) for part in (codec.shown, codec.raw))
            columns[1].append(hashlib.sha256(",".join(shown).encode()).hexdigest())
            columns[2].append(hashlib.sha256(b"".join(raw)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, columns)], schema=schema)

    def run(batches):
        codec, held, size = _codec(sent), [], 0
        for batch in slices(batches, "_text", _BATCH_BYTES):
            texts = batch.column("_text")
            held.append((batch, [codec.numbers(t) for t in texts.to_pylist()]))
            size += texts.nbytes
            if size >= HELD_BYTES or codec.pending() >= QUERY_WORDS:
                codec.learn()
                yield from (finish(codec, *one) for one in held)
                held, size = [], 0
                codec.forget()
        codec.learn()
        yield from (finish(codec, *one) for one in held)
        codec.forget()

    return rows.mapInArrow(giving_back(run), out)
