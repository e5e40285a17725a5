"""Work that has to stay in proportion to the input."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from pitwall.llm import jaccard, suffix
from pitwall.llm.packs import arrow_schema, bytes_of


def test_linked_sets_share_enough_pairs_of_neighbours():
    rng = np.random.default_rng(5)
    linked = 0
    for _ in range(4000):
        n = int(rng.choice([rng.integers(1, 30), rng.integers(30, 400)]))
        pool = rng.choice(1 << 62, 2 * n + 2, replace=False).astype(np.uint64)
        lost, new = rng.integers(0, n // 4 + 2, 2)
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[min(lost, n - 1) : n], pool[n : n + new]]))
        both = len(np.intersect1d(a, b))
        if len(a) == len(b) == both or 100 * both < 80 * (len(a) + len(b) - both):
            continue
        linked += 1
        shared = len(np.intersect1d(jaccard._front(a, True), jaccard._front(b, True)))
        assert shared >= max(jaccard.pairs_needed(len(a)), jaccard.pairs_needed(len(b))) > 0
    assert linked > 500
    # with the least in common, and all that differs among the first
    for n in (4, 5, 9, 10, 16, 17, 40, 99, 300):
        a = np.arange(n, dtype=np.uint64) * np.uint64(1000)
        b = a[n - jaccard.link_share(n, jaccard.must_share(n)) :] if n % 5 == 0 else a
        assert len(np.intersect1d(jaccard._front(a, True), jaccard._front(b, True))) >= jaccard.pairs_needed(n)


def test_chance_meetings_of_shingles_do_not_call_for_a_comparison(spark, monkeypatch):
    """Half of a document's shingles occur elsewhere, each in another document: no two are alike."""
    rng = random.Random(6)
    phrases = [" ".join(f"{p}w{k}" for k in range(6)) for p in range(2000)]
    texts = [" ".join(x for p in rng.sample(phrases, 20) for x in (p, *(f"u{rng.random()}" for _ in range(2)))) for _ in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[7] + " end"])], "doc_id long, text string")
    written, old = {}, jaccard.materialise

    def materialise(df, name):
        written[name] = old(df, name)
        return written[name]

    monkeypatch.setattr(jaccard, "materialise", materialise)
    found = {r.id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert found == {i: 7 if i == 200 else i for i in range(201)}
    assert written["alive"].count() == 2


def test_a_list_of_many_small_families_needs_few_rounds_of_stars(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_MOST", 4)
    apart = [(0, 9, i, i, 40, 3, 1) for i in range(1, 81)]
    apart = spark.createDataFrame(apart, jaccard._APART)
    body = [" ".join(f"f{i // 2}x{k}" for k in range(40)) + " end" * (i % 2) for i in range(82)]
    texts = spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(body)], "_id long, _text binary")
    links = spark.createDataFrame([(0, 1)], "a long, b long")
    rounds, old = [], jaccard._verify
    monkeypatch.setattr(jaccard, "_verify", lambda *x: rounds.append(1) or old(*x))
    links, rest = jaccard._thin(links, apart, texts, 5)
    assert 0 < len(rounds) <= 3
    # what the stars leave apart still stands in its list
    assert rest.count() == 80
    assert all(a // 2 == b // 2 for a, b in links.collect())


def test_a_list_of_two_families_is_thinned(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRS_MOST", 4)
    apart = spark.createDataFrame([(0, 9, i, i, 40, 3, 1) for i in range(1, 401)], jaccard._APART)
    texts = spark.createDataFrame([(i, bytearray(" ".join(f"f{i % 2}x{k}" for k in range(40)).encode())) for i in range(401)], "_id long, _text binary")
    links, rest = jaccard._thin(spark.createDataFrame([(0, 2)], "a long, b long"), apart, texts, 5)
    assert rest.select("component").distinct().count() == 2


def test_shingles_of_a_bucket_are_judged_in_parts(spark, monkeypatch):
    rng, rows = np.random.default_rng(1), []
    for k in range(40):
        h = rng.integers(0, 300, 50).astype(np.uint64) * np.uint64(0x3FFFFFFF1)
        keys, counts = np.array([k // 2, 100 + k]), np.array([30, 20])
        rows.append({"bucket": 0, "h": bytes_of(h, 6), "keys": keys.tobytes(), "counts": counts.tobytes()})
    table = pa.Table.from_pylist(rows, arrow_schema(jaccard._PACKED))
    for pairs in (True, False):
        found = []
        for part in (1 << 19, 100, 7):
            monkeypatch.setattr(jaccard, "JUDGED", part)
            judged = jaccard._judge_fronts(1, pairs, arrow_schema(jaccard._ANSWERS))(table)
            found.append(sorted(map(str, judged.to_pylist())))
        assert found[0] == found[1] == found[2] and len(found[0]) > 50


def test_chance_meetings_of_anchors_send_no_text(spark, monkeypatch):
    """Every text holds the same line of fewer than 50 bytes between others: nothing repeats, nothing is looked at."""
    rng = random.Random(7)
    own = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    line = own(28)
    rows = [(i, own(60) + line + own(60)) for i in range(40)]
    long = own(49)
    rows += [(100, "A" * 5 + long + "x" + own(30)), (101, own(40) + long + "x"), (102, own(3) + long + "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    written, old = {}, suffix.materialise

    def materialise(df, name):
        written[name] = old(df, name)
        return written[name]

    monkeypatch.setattr(suffix, "materialise", materialise)
    removed = {r.doc_id: r.n_removed for r in suffix.remove_repeats(docs).select("row.doc_id", "n_removed").collect()}
    assert removed == {**{i: 0 for i, _ in rows}, 101: 50}
    assert written["anchors"].selectExpr("sum(size(look) + size(hot)) as n").first().n <= 12


def test_strings_around_an_anchor_share_a_half(spark):
    """Copies of 50 bytes at any place beside an anchor, against all strings."""
    rng = random.Random(8)
    own = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    base = own(400)
    texts = []
    for _ in range(60):
        cut, size = rng.randrange(300), rng.choice([48, 49, 50, 51, 55, 70])
        texts.append(own(rng.randrange(40)) + base[cut : cut + size] + own(rng.randrange(40)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known, want = set(), {}
    for i, t in enumerate(texts):
        strings = [t[k : k + 50] for k in range(len(t) - 49)]
        gone = {k + j for k, s in enumerate(strings) if s in known for j in range(50)}
        want[i] = len(gone)
        known |= set(strings)
    found = {r.doc_id: r.n_removed for r in suffix.remove_repeats(docs).select("row.doc_id", "n_removed").collect()}
    assert found == want and sum(map(bool, want.values())) > 10
