"""Document fingerprints of closed syncmers, in DataFrame functions only.

A text is a sequence of words. Of the k-word substrings those are chosen whose least s-word substring, by hash, stands
at an edge. Whether one is chosen depends on its own words alone, so texts that share a passage share its anchors
wherever it stands, and an edit changes at most the k - 1 anchors on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

K, S = 5, 2
# White space parts words; scripts that are written without it are taken character by character.
_PARTS = r"[\x09-\x0D\x20]+|(?=[฀-໿぀-ヿ㐀-鿿가-힯])"
# A longer word, such as a text without white space, counts as the character sequences of _GRAM that begin in it.
_LONG, _GRAM = 32, 12
# Ids of one block share all bits but these, so a block has a bounded number of different ids.
_BLOCK_BITS, _LEVEL_BITS = 10, 12
_LOWEST = -(1 << 63)


def with_anchors(df: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with the array ``name`` of the anchors of column ``text``, 32-bit numbers in text order.

    A text without a closed syncmer, as all of fewer than ``k`` words, is one anchor; a text without words has none.
    Each step is a column of its own, so that nothing is computed twice.
    """
    if not 0 < s < k:
        raise ValueError("s must be from 1 to k - 1")
    parts, words, small, n = f"_{name}_parts", f"_{name}_words", f"_{name}_small", f"_{name}_n"

    def grams(w: Column) -> Column:
        # an array of one array, so that a word is split once and not for each of its sequences
        found = F.transform(F.array(F.split(w, "")), lambda chars: F.transform(F.slice(chars, 1, F.size(chars) - _GRAM + 1), lambda c, i: F.xxhash64(c, *(F.get(chars, i + j) for j in range(1, _GRAM)))))
        return F.get(found, F.lit(0))

    def pieces(w: Column) -> Column:
        return F.when(F.char_length(w) <= _LONG, F.array(F.xxhash64(w))).otherwise(grams(w))

    df = df.withColumn(parts, F.filter(F.split(F.lower(text), _PARTS), lambda w: w != ""))
    long = F.exists(parts, lambda w: F.char_length(w) > _LONG)
    plain = F.transform(parts, lambda w: F.xxhash64(w))
    df = df.withColumn(words, F.when(long, F.flatten(F.transform(parts, pieces))).otherwise(plain))
    df = df.withColumn(n, F.size(words))
    if s == 1:
        df = df.withColumn(small, F.col(words))
    else:
        df = df.withColumn(
            small, F.transform(words, lambda x, i: F.xxhash64(x, *(F.get(F.col(words), i + j) for j in range(1, s))))
        )
    last = k - s

    def at(i: Column, j: int) -> Column:
        return F.get(F.col(small), i + j)

    def chosen(x: Column, i: Column) -> Column:
        inner = [at(i, j) for j in range(1, last)]
        edge = F.least(x, at(i, last))
        closed = edge <= (F.least(*inner) if len(inner) > 1 else inner[0]) if inner else F.lit(True)
        covering = [x, *(at(i, j) for j in range(s, last, s)), at(i, last)]
        return F.when((i + k <= F.col(n)) & closed, F.xxhash64(*covering).bitwiseAND(F.lit(0xFFFFFFFF)))

    whole = F.array(F.xxhash64(words).bitwiseAND(F.lit(0xFFFFFFFF)))
    df = df.withColumn(name, F.filter(F.transform(small, chosen), lambda a: a.isNotNull()))
    found = F.when((F.size(name) == 0) & (F.col(n) > 0), whole).otherwise(F.coalesce(name, F.array().cast("array<bigint>")))
    return df.withColumn(name, found).drop(parts, words, small, n)


def shown(anchors: str) -> Column:
    """A fingerprint as text: the anchors in order, in hexadecimal."""
    return F.array_join(F.transform(anchors, lambda a: F.hex(a)), ".")


def likeness(a: str, b: str) -> Column:
    """Common different anchors as a share of the larger number of different anchors; 1 for two empty ones."""
    most = F.greatest(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.when(most == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / most)


def anchor_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, s: int = S) -> DataFrame:
    """(id, at, anchor): the anchors of each text in order, for joins that match passages by position."""
    text = F.coalesce(F.col(text_column), F.lit("")).alias("_text")
    found = with_anchors(docs.select(F.col(id_column).alias("id"), text), "_text", "_anchors", k, s)
    return found.select("id", F.posexplode("_anchors").alias("at", "anchor"))


def _followers(blocks: DataFrame) -> DataFrame:
    """(block, higher): the next higher block of each, null for the highest; no group has over 2^12 rows."""
    few = Window.orderBy("block")
    if blocks.count() <= 1 << _LEVEL_BITS:
        return blocks.select("block", F.lead("block").over(few).alias("higher"))
    up = F.shiftright("block", _LEVEL_BITS).alias("parent")
    own = Window.partitionBy("parent").orderBy("block")
    inner = blocks.select("block", up).withColumn("higher", F.lead("block").over(own))
    parents = materialise(blocks.groupBy(up).agg(F.min("block").alias("least")), "parents")
    above = _followers(parents.select(F.col("parent").alias("block"))).withColumnRenamed("block", "parent")
    least = parents.select(F.col("parent").alias("higher"), "least")
    above = above.join(least, "higher").select("parent", "least")
    return inner.join(above, "parent", "left").select("block", F.coalesce("higher", "least").alias("higher"))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Struct ``row`` with all columns but the text, the ``text`` (null: empty), ``anchors``, and ``next_text`` and
    ``next_anchors`` of the next document by descending id; after the last comes the first.

    Rows with equal ids follow each other by hash of their text. A row without an id stands last. A single row is its
    own next one. The texts are shuffled once, by blocks of ids; the highest row of each block is also sent to the
    next higher block, where it follows that block's last row.
    """
    rest = F.struct(*(c for c in docs.columns if c != text_column)).alias("row")
    order = F.coalesce(F.col(id_column).cast("long"), F.lit(_LOWEST)).alias("_id")
    rows = docs.select(rest, order, F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_block", F.shiftright("_id", _BLOCK_BITS))
    blocks = materialise(rows.groupBy(F.col("_block").alias("block")).agg(F.max("_id").alias("highest")), "blocks")
    lowest = blocks.agg(F.min("block")).first()[0]
    to = _followers(blocks.select("block")).join(blocks, "block")
    to = materialise(to.select(F.col("highest").alias("_id"), F.coalesce("higher", F.lit(lowest)).alias("_to")), "followers")
    guests = rows.join(broadcast_if_small(to), "_id").select("row", "_id", "text", F.col("_to").alias("_block"))
    both = rows.withColumn("_guest", F.lit(0)).unionByName(guests.withColumn("_guest", F.lit(1)))
    both = with_anchors(both.repartition("_block"), "text", "anchors", k, s)
    along = Window.partitionBy("_block").orderBy("_guest", F.desc("_id"), F.xxhash64("text"))
    both = both.withColumns({"next_text": F.lead("text").over(along), "next_anchors": F.lead("anchors").over(along)})
    return both.filter("_guest = 0").select("row", "text", "anchors", "next_text", "next_anchors")


def edited(found: DataFrame) -> DataFrame:
    """``found`` with ``n_chars`` and ``edited``: the last third of the text replaced by the start of the next one."""
    found = found.withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third)
    return found.withColumn("edited", F.concat(kept, F.substring("next_text", F.lit(1), third)))
