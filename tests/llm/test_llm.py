"""Operators of the training-data part against brute force, on rows with nulls, ties, repeats, long and empty texts."""

import hashlib
import random
import re
from collections import defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pitwall.llm import arrays, bpe, graphs, hamming, jaccard, mixing, ppm, queries, resampling, suffix, syncmers, url_lists, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, size long"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _texts(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, base = prose(40), prose(120).split()
    texts = [None, "", " \t\n", "One", "one", "two words", "a b c d e", "A b C d e", passage, passage, "é" * 60, "日本語テキスト" * 12]
    texts += [prose(30) + " " + passage + " " + prose(30) for _ in range(6)]
    for _ in range(12):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(len(near))] = word()
        texts.append(" ".join(near))
    short = prose(12).split()
    texts += [" ".join(short), " ".join(short[:-1]), " ".join([*short, "x"]), "z" * 3000, prose(4000)]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xy"[i % 2], [None, "s1", "s2", "é"][i % 4], 0, "r", 1, 2) for i, t in enumerate(_texts())]
    rows += [(5, "two words", "x", "s1", 0, "r", 1, 2), (None, _texts()[8], None, None, 0, "r", 1, 2)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _order(i):
    return 1 << 62 if i is None else i


def test_repeats_against_all_strings(docs, none):
    rows = docs.select("doc_id", "text").collect()
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], _order(i)), _order(i))
    want = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < _order(i):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        want.append((i, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    found = suffix.remove_repeats(docs).select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert sorted((r[0], *r[1:4], bytes(r[4])) for r in found if r[0] is not None) == sorted(w for w in want if w[0] is not None)
    assert [(r[1], r[2]) for r in found if r[0] is None] == [w[1:3] for w in want if w[0] is None]
    assert suffix.remove_repeats(none).count() == 0


def test_hot_anchors_give_the_same_rows(docs, monkeypatch):
    plain = suffix.remove_repeats(docs).select("row.doc_id", "n_removed", F.sha2("kept", 256)).collect()
    monkeypatch.setattr(suffix, "HOT", 1)
    monkeypatch.setattr(suffix, "SPREAD", 1)
    hot = suffix.remove_repeats(docs).select("row.doc_id", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, hot))


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def test_near_duplicates_against_all_pairs(docs, none):
    rows = [(i, _shingles(t)) for i, t in docs.select("doc_id", "text").collect()]
    up = {i: i for i, _ in rows if i is not None}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    found = jaccard.near_duplicates(docs).collect()
    want = [(i, len(s), None if i is None else top(i)) for i, s in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    assert jaccard.near_duplicates(none).count() == 0


def test_light_and_heavy_agree(docs, monkeypatch):
    found = []
    for boundary in (0, 20):
        monkeypatch.setattr(jaccard, "light_boundary", lambda *_, boundary=boundary: boundary)
        found.append(sorted(map(repr, jaccard.near_duplicates(docs).collect())))
    assert found[0] == found[1]


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (5, 5), (2, 1)], "a long, b long")
    assert sorted(map(tuple, graphs.components(links).collect())) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 6), (7, 6), (8, 6), (9, 6)]


def test_bpe_against_the_library(docs, none):
    ranks = bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["a" * 500, "  \n x <|endoftext|>", "12345678901", "日本語 ééé", "the" * 400]
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    for text in [t or "" for t in _texts()] + texts:
        ids = [i for word in codec.encode_words(codec.words.findall(text)) for i in word]
        assert ids == own.encode_ordinary(text)
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, PATH, public_tokenizers.PATTERN).select("row.row.text", "decoded").collect()
    assert len(back) == docs.count() and all((t or "").encode() == bytes(b) for t, b in back)
    for text, n, ids, raw in bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).select("row.text", "n_tokens", "ids_sha256", "decoded_sha256").collect():
        want = own.encode_ordinary(text or "")
        assert n == len(want) and ids == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert raw == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(none, PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_of_overlapping_pairs_and_rows_of_its_query():
    ranks = bpe.read_ranks(PATH)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec, rng = bpe.Codec(ranks, public_tokenizers.PATTERN), random.Random(8)
    texts = [c * n for c in "a-=_ *0é日" for n in (1, 2, 3, 5, 8, 13, 24, 47, 48, 49, 60)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 50))) for letters in ("ab", "-=", "ha", "naéè", "*") for _ in range(40)]
    words = list(dict.fromkeys(w for text in texts for w in codec.words.findall(text)))
    assert codec.encode_words(words) == [own.encode_ordinary(w) for w in words]
    # between two rounds a short word is one row
    steps = bpe._MERGE.rsplit("\nselect", 1)[0] + "\nselect max(n) from (select count(*) as n from step group by round, word)"
    codec.db.execute("create table start_words as select 0::int as word, ? as tokens", ["".join(map(codec.chars.__getitem__, b"tokenization"))])
    assert codec.db.execute(steps).fetchall() == [(1,)]


def test_language(spark, docs, none):
    rng = random.Random(1)
    say = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(20))
    rows = [(i, say("aeioulmn"), "left") for i in range(40)] + [(i, say("krtszwüß"), "right") for i in range(40, 80)]
    model = ppm.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probe = spark.createDataFrame([(1, say("aeioulmn")), (2, say("krtszwüß")), (3, "123 !"), (4, None), (5, "ß")], "doc_id long, text string")
    found = {r[0]: (r[1], r[2]) for r in ppm.identify(probe, model).select("row.doc_id", "lang_pred", "score").collect()}
    assert [found[i][0] for i in (1, 2, 3, 4)] == ["left", "right", "und", "und"] and found[5][0] == "right"
    assert all(0 <= s <= 1 for _, s in found.values()) and found[1][1] > 0.9
    assert ppm.identify(docs, model).count() == docs.count() and ppm.identify(none, model).count() == 0
    assert ppm.fit(none) is None and set(ppm.identify(docs, None).select("lang_pred").collect()) == {("und",)}


def test_targets_and_flow():
    sizes, weights = {"a": 10, "b": 100, None: 100}, {"a": 5, "b": 2, None: 1}
    goal = mixing.targets(sizes, weights, 315)
    assert [float(goal[s]) for s in ("a", "b", None)] == [20, 295 * 2 / 3, 295 / 3]
    flow = mixing.route({("a",): 10, ("a", "b"): 30, ("b",): 5}, {"a": 40, "b": 20})
    assert sum(f.get("a", 0) for f in flow.values()) == 40 and sum(f.get("b", 0) for f in flow.values()) == 20
    assert all(sum(f.values()) <= 2 * n for f, n in zip(flow.values(), (10, 30, 5), strict=True))


def test_mix(spark, none):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice(["a", "b", "c", None])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found, sources = mixing.mix(docs)
    found = found.select("row.doc_id", "row.source", "size", "taken").collect()
    goal = {s: (n, t) for s, n, t in sources.collect()}
    taken, size = defaultdict(int), defaultdict(int)
    for _, s, n, t in found:
        taken[s] += t
        size[s] += n
        assert t <= 2 * n
    assert all(size[s] == n and abs(taken[s] - t) <= 15 for s, (n, t) in goal.items())
    again = mixing.mix(docs)[0].select("row.doc_id", "row.source", "size", "taken").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))
    many = docs.withColumn("source", F.array(F.col("source"), F.lit("a")))
    found, sources = mixing.mix(many)
    assert found.count() == 400 and all(r.taken <= 2 * r.size for r in found.collect())
    assert [t.count() for t in mixing.mix(none)] == [0, 0]


def test_fingerprints(docs, none):
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows.sort(key=lambda r: (-(r.doc_id if r.doc_id is not None else -1), r.h))
    found = syncmers.with_anchors(syncmers.edited(syncmers.fingerprints(docs)), "edited", "edited_anchors")
    found = found.withColumns({"near": syncmers.likeness("anchors", "edited_anchors"), "shown": syncmers.shown("anchors")}).collect()
    want = [(a.doc_id, a.text[: len(a.text) - len(a.text) // 3] + b.text[: len(a.text) // 3]) for a, b in zip(rows, rows[1:] + rows[:1], strict=True)]
    assert sorted(map(repr, want)) == sorted(repr((r.row.doc_id, r.edited)) for r in found)
    by_text = defaultdict(set)
    for r in found:
        by_text[r.text].add(r.shown)
        assert 0 <= r.near <= 1
    assert all(len(s) == 1 for s in by_text.values())
    assert syncmers.fingerprints(none).count() == 0


def test_closed_syncmers_are_context_free(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    shared = prose(50)
    rows = spark.createDataFrame([(1, shared), (2, prose(7) + " " + shared + " " + prose(9))], "doc_id long, text string")
    found = syncmers.anchor_rows(rows).collect()
    inner, outer = ({r.anchor for r in found if r.id == i} for i in (1, 2))
    assert inner and inner <= outer


def test_top_k_against_all_pairs(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) - (1 << 63) for _ in range(150)]
    rows = [(i, [base[i % 150] ^ (1 << rng.randrange(60)) * (i >= 150)]) for i in range(300)]
    codes = spark.createDataFrame(rows, "id long, code array<long>")
    found = hamming.top_k(codes, codes.filter("id % 50 = 0"), 5, 64).collect()
    want = []
    for i, (a,) in rows[::50]:
        near = sorted((bin((a ^ b) & ((1 << 64) - 1)).count("1"), j) for j, (b,) in rows)[:5]
        want += [(i, r + 1, j, d) for r, (d, j) in enumerate(near)]
    assert sorted(map(tuple, found)) == sorted(want)
    assert hamming.top_k(codes.limit(0), codes.limit(0), 5, 64).count() == 0


def test_warc(spark, tmp_path):
    path, url = str(tmp_path / "archive"), "http://x/\r\n"
    rows = [("urn:page:1", "response", url, "2024-01-01", None, "ab" * 20, 5, b"hello"), ("urn:page:2", "revisit", None, "2024-01-02", "urn:page:1", "ab" * 20, 5, None)]
    rows += [(f"urn:page:{i}", "response", "u", "2023", None, None, None, bytes([i % 256]) * i * 300) for i in range(3, 40)]
    warc.write_warc(spark.createDataFrame(rows, warc.FIELDS).repartition(3), path)
    (tmp_path / "archive" / "left-behind.warc.gz").write_bytes(b"broken")
    found = {r.record_id: r for r in warc.read_warc(spark, path).collect()}
    assert len(found) == 39 and found["urn:page:1"].target_uri == "http://x/%0D%0A"
    assert all(bytes(found[r[0]].payload) == r[7] and found[r[0]].payload_bytes == len(r[7]) for r in rows[2:])
    assert found["urn:page:2"].payload is None and found["urn:page:2"].payload_bytes == 5
    light = warc.read_warc(spark, path, payload=False).filter("record_type = 'revisit' and date >= '2024'")
    # the source takes both filters, so none is left above it
    assert "Filter (" not in light._jdf.queryExecution().executedPlan().toString()
    assert [r.refers_to for r in light.collect()] == ["urn:page:1"]


def _unpacked(path, kind, payloads):
    """Bytes that reading the records of one type unpacks, of how many."""
    from pathlib import Path

    seen, every = 0, 0
    for file in Path(path).glob("*.warc.gz"):
        with warc.pafs.LocalFileSystem().open_input_file(str(file)) as opened:
            real = warc._Member.more

            def more(self, most=0, real=real):
                nonlocal seen
                part = real(self, most)
                seen += len(part)
                return part

            warc._Member.more = more
            try:
                every += len(list(warc.records(opened, file.stat().st_size, lambda row: row["record_type"] == kind, payloads)))
            finally:
                warc._Member.more = real
    return seen, every


def test_unwanted_payloads_stay_packed(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = [(f"urn:page:{i}", "revisit" if i % 4 == 0 else "response", "u", "2024", None, None, 200_000, b"" if i % 4 == 0 else b"x" * 200_000) for i in range(40)]
    warc.write_warc(spark.createDataFrame(rows, warc.FIELDS).coalesce(1), path)
    whole, n = _unpacked(path, "response", True)
    assert n == 30 and whole > 30 * 200_000
    light, n = _unpacked(path, "response", False)
    assert n == 30 and light < 40 * 3000
    none, n = _unpacked(path, "revisit", True)
    assert n == 10 and none < 40 * 3000


def test_archives_of_others(tmp_path):
    """A digest in hexadecimal digits, and members without the length in their header."""
    import gzip

    digest, file = "ab" * 20, tmp_path / "a.warc.gz"
    head = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha1:{}\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    file.write_bytes(gzip.compress(head.format(digest.upper()).encode()) + gzip.compress(head.format("7777777777777777" * 2).encode()))
    with warc.pafs.LocalFileSystem().open_input_file(str(file)) as opened:
        found = list(warc.records(opened, file.stat().st_size, lambda row: True, True))
    assert [r[5] for r in found] == [digest, "ff" * 20] and [r[-1] for r in found] == [b"hello"] * 2


def test_archive_query_reads_what_it_reports(spark, tmp_path):
    pages = [(1, "u", "a" * 2000), (2, "u", "a" * 2000), (3, None, None), (4, "v", "é" * 400), (5, "v", "é" * 400), (6, "w", "é" * 600), (6, "w", "é" * 600)]
    spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op2_warc_archive(spark, str(tmp_path)).collect()
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = [(i, len((t or "").encode()), sha(t), "revisit" if i == 1 else "response", 2 if i == 1 else None) for i, _, t in pages]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert queries.op2_warc_archive(spark, f"{tmp_path}/none").count() == 0


def test_url_lists(spark):
    entries = [("spam", "host", "a.b.com", 10, "add"), ("spam", "host", "a.b.com", 20, "remove"), ("spam", "host", "a.b.com", 90, "add"),
               ("x", "domain", "b.com", 5, "add"), ("p", "prefix", "a.b.com/q/", 0, "add"), (None, "host", "a.b.com", 0, "add"),
               ("t", "url", "odd", 3, "add"), ("t", "url", "odd", 3, "remove")]
    entries = spark.createDataFrame(entries, "list string, kind string, pattern string, day int, action string")
    captures = [(1, "http://A.b.com/q", 9), (2, "https://u@a.b.com:80/q/r?x", 10), (3, "http://a.b.com/z", 20), (4, "http://a.b.com/q/", 400),
                (5, None, 3), (6, "odd", 3), (7, "http://a.b.com/", None), (2, "https://u@a.b.com:80/q/r?x", 10)]
    captures = spark.createDataFrame(captures, "lists int, url string, fetch_day int")
    found = sorted((r[0], r[1]) for r in url_lists.active_lists(captures, entries).select("row.lists", "lists").collect())
    assert found == [(1, ["p", "x"]), (2, ["p", "spam", "x"]), (2, ["p", "spam", "x"]), (3, ["x"]), (4, ["p", "spam", "x"]), (5, []), (6, []), (7, [])]
    assert url_lists.active_lists(captures.limit(0), entries).count() == 0
    assert {tuple(r.lists) for r in url_lists.active_lists(captures, entries.limit(0)).collect()} == {()}


def test_url_lists_with_wild_days_and_long_urls(spark, monkeypatch):
    entries = [("spam", "host", "a.com", 0, "add"), ("old", "host", "a.com", -(10**15), "add"), ("old", "host", "a.com", 7, "remove"),
               ("p", "prefix", "a.com/x/y/", 3, "add"), ("d", "domain", "b.a.com", 5, "add"), ("far", "host", "a.com", 3 * 10**10, "add")]
    entries = spark.createDataFrame(entries, "list string, kind string, pattern string, day long, action string")
    long_url = "http://c.b.a.com/" + "x/" * 500_000
    days = [3 * 10**10, 10**15, -(10**15) - 1, -(10**14), 6, 7]
    captures = [("http://a.com/x/y/z", d) for d in days] + [(long_url, 6), ("http://" + "w." * 500 + "b.a.com", 6)]
    captures = spark.createDataFrame(captures, "url string, fetch_day long")
    want = {0: {"spam", "p", "far"}, 1: {"spam", "p", "far"}, 2: set(), 3: {"old"}, 4: {"old", "spam", "p"}, 5: {"spam", "p"}, 6: {"d"}, 7: {"d"}}
    for most in (4096, 2):
        monkeypatch.setattr(url_lists, "BLOCKS_MOST", most)
        found = {(r.row.url, r.row.fetch_day): set(r.lists) for r in url_lists.active_lists(captures, entries).collect()}
        assert found == {tuple(c): want[i] for i, c in enumerate(captures.collect())}


def test_resampling(docs, none, spark):
    target = docs.filter("doc_id % 3 = 0").select("doc_id")
    found = resampling.resample(docs, target, 7).select("row.doc_id", "log_weight", "key", "selected").collect()
    ranked = sorted(found, key=lambda r: (-r.key, _order(r.doc_id)))
    assert [r.selected for r in ranked[:7]] == [True] * 7 and len(found) == docs.count()
    assert sum(r.selected for r in found) <= 8  # wholly equal rows go together
    assert resampling.resample(none, target, 3).count() == 0


def test_shingles_ignore_white_space():
    import numpy as np

    sets = [arrays.shingle_sets(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].tolist() for t in (b"A b c d e f", b" a  b\tc d\ne f ")]
    assert sets[0] == sets[1] and len(sets[0]) == 2


def _mixed_words(docs, **share):
    found, sources = mixing.mix(docs, **share)
    return found.agg(F.sum("taken")).first()[0], sources.first().target


def test_mix_reaches_the_target_beside_a_very_long_document(spark):
    sizes = spark.range(2001).selectExpr("id as doc_id", "if(id = 0, 200000, 100) as n").repartition(3)
    docs = sizes.selectExpr("doc_id", "repeat('w ', n) as text", "'a' as source")
    assert _mixed_words(docs, share=mixing.Fraction(6, 10)) == (240_000, 240_000)
    assert _mixed_words(docs.filter("doc_id < 11"), share=mixing.Fraction(1, 100)) == (1000, 2010)
    short = docs.withColumn("text", F.expr("if(doc_id = 0, repeat('w ', 2000), text)")).filter("doc_id < 11")
    words, target = _mixed_words(short, share=mixing.Fraction(3, 4))
    assert target == 2250 and abs(words - target) == 50


def test_mix_cuts_units_of_several_documents(spark, monkeypatch):
    rows = [(i, "w " * (1 + i * 37 % 90), "ab"[i % 2]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    monkeypatch.setattr(mixing, "_UNITS", 2)
    monkeypatch.setattr(mixing, "_UNIT_BITS", 60)
    found, sources = mixing.mix(docs, share=mixing.Fraction(2, 5))
    taken = {r[0]: r[1] for r in found.groupBy("row.source").agg(F.sum("taken")).collect()}
    assert all(abs(taken[s] - target) <= 1 for s, _, target in sources.collect())


def test_short_texts_have_different_fingerprints(spark):
    rng = random.Random(6)
    texts = [" ".join(str(rng.randrange(10**9)) for _ in range(n)) for n in (1, 2, 4, 5, 6, 7) for _ in range(40)]
    rows = spark.createDataFrame([(t,) for t in [*texts, "", " \t", None]], "text string")
    found = syncmers.with_anchors(rows, "text", "anchors").select("text", "anchors").collect()
    assert all(r.anchors for r in found if r.text and r.text.strip()) and len({tuple(r.anchors) for r in found}) == len(texts) + 1
    assert [r.anchors for r in found[-3:]] == [[], [], []]


def test_an_edit_of_a_text_without_white_space_is_local(spark):
    rng = random.Random(7)
    a, b = ("".join(rng.choice("acgtéß") for _ in range(3000)) for _ in range(2))
    rows = spark.createDataFrame([(a, a[:1000] + "x" + a[1001:], b)], "a string, near string, b string")
    for c in rows.columns:
        rows = syncmers.with_anchors(rows, c, f"{c}_anchors")
    near, far = rows.select(syncmers.likeness("a_anchors", "near_anchors"), syncmers.likeness("a_anchors", "b_anchors")).first()
    assert 0.98 < near < 1 and far < 0.01
