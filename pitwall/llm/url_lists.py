"""URL filters by dated lists: an as-of join of captures with the entries active at fetch time.

An entry says that from a day on a pattern is on a list, or no longer on it. The entries of a pattern become validity
intervals, cut at blocks of days. A capture has a few keys (its URL, its host and the domains above it, its path
prefixes), and one equi-join on key and block with the interval as residual finds what was active. A pattern with a
long history meets a capture only in the block of the fetch day, and a host with very many captures is split by the
skew handling of the join. Blocks are made only where captures lie, and wider ones if these days are scattered, so any
integer may be a day. A URL gives no more prefixes and domains than the longest listed ones have steps and labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

BLOCK_DAYS = 32
# Blocks with captures; beyond, blocks get wider.
BLOCKS_MOST = 4096


def host(url):
    """The lower-case host of a URL without user and port; null without one."""
    name = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(name, F.lit(""))


def path(url):
    """The path of a URL, at least a slash."""
    return F.concat(F.lit("/"), F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, kind, pattern, valid_from, valid_to) from entries (list, kind, pattern, day, action).

    ``action`` is add or remove, others and nulls in any column but ``pattern`` leave the entry out, as does a null
    pattern. Of entries of one day a removal wins. An entry holds until the next one of its pattern, the last one
    without end. Repeated entries change nothing.
    """
    known = entries.select("list", "kind", "pattern", "day", "action").dropna()
    known = known.filter(F.col("action").isin("add", "remove"))
    daily = known.groupBy("list", "kind", "pattern", "day").agg(F.max("action").alias("action"))
    later = F.lead("day").over(Window.partitionBy("list", "kind", "pattern").orderBy("day"))
    held = daily.withColumn("valid_to", later).filter("action = 'add'")
    return held.select("list", "kind", "pattern", F.col("day").alias("valid_from"), "valid_to")


def keys(url, steps: int, labels: int):
    """All (kind, pattern) under which lists may name a URL, with prefixes of up to ``steps`` steps and domains of up
    to ``labels`` labels, as an array."""
    # whatever the lists name, the parts of a URL are looked at once
    name, parts = host(url), F.reverse(F.slice(F.reverse(F.split(host(url), r"\.")), 1, max(labels, 1)))
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    front = F.slice(F.split(F.rtrim(path(url), F.lit("/")), "/", steps + 2), 1, steps + 1)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(front)), lambda i: F.concat(name, F.array_join(F.slice(front, 1, i), "/"), F.lit("/"))
    )
    named = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("pattern")))
    found = F.concat(
        named("url", F.array(url)), named("host", F.array(name)), named("domain", above), named("prefix", F.array_distinct(prefixes))
    )
    return F.when(name.isNotNull(), found).otherwise(named("url", F.array(url)))


def _blocks(days: DataFrame) -> tuple[int, list[int]]:
    """The width of a block and all blocks with a day, a bounded number."""
    width = BLOCK_DAYS
    while True:
        # at most one more than the bound comes to the driver
        found = days.select(F.floor(F.col("_day") / width).alias("b")).distinct().limit(BLOCKS_MOST + 1).collect()
        if len(found) <= BLOCKS_MOST:
            return width, sorted(r.b for r in found)
        width *= 16


def active_lists(captures: DataFrame, entries: DataFrame, url_column: str = "url", day_column: str = "fetch_day") -> DataFrame:
    """Struct ``row`` with all columns of ``captures``, and ``lists``, the sorted names of the lists that name the URL
    on the fetch day.

    ``day`` and the fetch day are integers of up to 52 bits. A null URL or day is on no list. Repeated captures are
    judged alike. Empty tables give no rows or no lists.
    """
    rows = captures.select(
        F.struct(*captures.columns).alias("row"), F.col(url_column).cast("string").alias("_url"), F.col(day_column).cast("long").alias("_day")
    )
    asked = rows.select("_url", "_day").dropna().distinct()
    width, used = _blocks(rows.select("_day").dropna())

    held = materialise(intervals(entries), "intervals")
    of_kind = lambda kind, parts: F.max(F.when(F.col("kind") == kind, F.size(F.split("pattern", parts))))
    steps, labels = held.agg(of_kind("prefix", "/"), of_kind("domain", r"\.")).first()
    begin, end = F.floor(F.col("valid_from") / width), F.floor((F.col("valid_to") - 1) / width)
    inside = F.filter(F.lit(used).cast("array<long>"), lambda b: (b >= begin) & (b <= F.coalesce(end, b)))
    held = materialise(held.withColumn("_block", F.explode(inside)), "interval_blocks")

    probes = asked.select("_url", "_day", F.explode(keys(F.col("_url"), steps or 0, labels or 0)).alias("_k"))
    probes = probes.select("_url", "_day", "_k.kind", "_k.pattern", F.floor(F.col("_day") / width).alias("_block"))
    met = probes.join(broadcast_if_small(held), ["kind", "pattern", "_block"])
    met = met.filter((F.col("valid_from") <= F.col("_day")) & (F.coalesce(F.col("valid_to"), F.col("_day") + 1) > F.col("_day")))
    found = met.groupBy("_url", "_day").agg(F.array_sort(F.collect_set("list")).alias("lists"))
    none = F.array().cast("array<string>")
    return rows.join(found, ["_url", "_day"], "left").select("row", F.coalesce("lists", none).alias("lists"))
