"""Personal data, conversation repair and hard negatives against brute force, with nulls, ties, repeats and long rows."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitwall.llm import arrays, negatives, pii, ppm, queries, resampling, suffix, syncmers, turns

# --- personal data --------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        odd = [int(d) for d in digits[-1::-2]]
        even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
        return 14 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _base(text):
    found = [(m.start(), no, m.end(), kind) for no, (kind, rule) in enumerate(BASE.items()) for m in re.finditer(rule, text or "") if _valid(kind, m[0])]
    return sorted(found)


def _noise(rng):
    return "".join(rng.choice("a1.@+- 2()é😀4%_\n9") for _ in range(rng.randint(0, 150)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    fixed = [
        None, "", " ", "a@b.c_d@e.f g@h.i", "1.2.3.4.5.6.7.8 000.0.0.0 0.00.256.1 300.1.1.1 1.2.3.0255",
        "card 4111 1111-1111 1111 é😀 4111111111111111 4111111111111112", "+1 (741) 555-3069 +49-+12 3456 7890 1 ",
        "é😀" * 5 + "x@y.zz", ("a@b.cc 1.2.3.4 +1 (741) 555-3069 ") * 3000,
    ]
    return fixed + [_noise(rng) for _ in range(300)] + [fixed[3]]


def test_personal_data_against_search_of_each_kind(spark, texts):
    rows = spark.createDataFrame([(None if i == 7 else i % 200, t, "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, spans string, row int")
    found = pii.find(rows.repartition(4)).collect()
    assert len(found) == len(texts)
    for r in found:
        assert [(s.start, s.kind_no, s.end, s.kind) for s in r.spans if s.base] == _base(r.row.text)
        assert all(s.value == r.row.text[s.start : s.end] for s in r.spans)
    assert pii.find(rows.limit(0)).count() == 0


def test_long_runs_take_linear_time(spark):
    rows = spark.createDataFrame([("1" * 1_000_000,), ("a" * 1_000_000,), ("1." * 300_000,), ("1 " * 300_000,)], "text string")
    found = [len(r.spans) for r in pii.find(rows).collect()]
    assert found == [0, 0, 75_000, 0]


def test_checksums_and_words_decide_on_other_spans(spark):
    cases = [
        ("IBAN DE89 3704 0044 0532 0130 00,", [("iban", 100)]),
        ("GB82WEST12345698765432", [("iban", 80)]),
        ("GB82WEST12345698765433", []),
        ("my ssn: 123-45-6789", [("ssn", 60)]),
        ("123-45-6789", []),
        ("ssn 666-45-6789 or 123-00-6789", []),
        ("test ssn 123-45-6789", []),
    ]
    rows = spark.createDataFrame([(t,) for t, _ in cases], "text string").coalesce(1)
    assert [[(s.kind, s.score) for s in r.spans if not s.base] for r in pii.find(rows).collect()] == [w for _, w in cases]
    scored = spark.createDataFrame([("visa card 4111111111111111",), ("order 4111111111111111",), ("4111111111111111",)], "text string").coalesce(1)
    assert [r.spans[0].score for r in pii.find(scored).collect()] == [100, 60, 80]


def test_personal_data_query_and_plan(spark, sf):
    df = queries.op12_personal_data(spark, sf)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in df.collect():
        base = _base(texts[r.doc_id])
        shown = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in base)
        assert r.base_sha256 == hashlib.sha256(shown.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[3] == k for b in base) for k in BASE)


# --- longest previous factors ---------------------------------------------------------------


@pytest.mark.parametrize("depth", [8, 11, 16, 50])
def test_suffix_arrays_against_brute_force(depth):
    rng = random.Random(depth)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(depth, 3 * depth))) for _ in range(rng.randint(1, 6))]
        texts += [texts[0][: rng.randint(depth, len(texts[0]))], texts[-1]]
        ids = [rng.randint(0, 5) for _ in texts]
        data, start, owner = b"".join(texts), [], []
        for k, text in enumerate(texts):
            base = sum(map(len, texts[:k]))
            start += [base + i for i in range(len(text) - depth + 1)]
            owner += [ids[k]] * (len(text) - depth + 1)
        strings = [data[i : i + depth] for i in start]
        raw, at, by = np.frombuffer(data, np.uint8), np.array(start), np.array(owner)
        words = suffix._words(raw, at, depth)
        order = suffix.suffix_array(words)
        assert [strings[i] for i in order] == sorted(strings)
        lcp = suffix.common_prefixes(words, order, depth)

        def shared(a, b):
            return next((k for k in range(depth) if a[k] != b[k]), depth)

        ranked, named = [strings[i] for i in order], by[order]
        assert lcp.tolist() == [0, *(shared(a, b) for a, b in zip(ranked, ranked[1:], strict=False))]
        before, prefix = suffix.nearest_smaller(named, lcp)
        for i in range(len(ranked)):
            want = max((j for j in range(i) if named[j] < named[i]), default=-1)
            assert before[i] == want and prefix[i] == (shared(ranked[want], ranked[i]) if want >= 0 else 0)
        factors = suffix.longest_previous_factors(named, lcp)
        assert factors.tolist() == [
            max((shared(b, a) for b, d in zip(ranked, named, strict=True) if d < c), default=0) for a, c in zip(ranked, named, strict=True)
        ]
        hit = suffix.later_copies(raw, at, by, depth)
        assert hit.tolist() == [any(s == t and j < i for t, j in zip(strings, owner, strict=True)) for s, i in zip(strings, owner, strict=True)]


# --- language, fingerprints, resampling -----------------------------------------------------


def _code_length(train, text):
    """Bits of a text by prediction by partial matching, byte by byte."""
    counts = defaultdict(lambda: defaultdict(int))
    for one in train:
        raw = b"   " + one.encode()
        for i in range(3, len(raw)):
            for order in range(4):
                counts[raw[i - order : i]][raw[i]] += 1
    raw, total = b"   " + text.encode(), 0.0
    for i in range(3, len(raw)):
        for order in (3, 2, 1, 0):
            after = counts.get(raw[i - order : i])
            if after is None:
                continue
            n, different = sum(after.values()), len(after)
            if raw[i] in after:
                total -= math.log2(after[raw[i]] / (n + different))
                break
            total -= math.log2(different / (n + different))
        else:
            total += 8
    return total


def test_code_lengths_against_a_plain_coder(spark, monkeypatch):
    rng = random.Random(3)
    say = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    train = {"a": [say("abc dE", 60) for _ in range(8)], "b": [say("xyz éß", 50) for _ in range(8)], "c": ["q"]}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in train.items() for t in ts)]
    model = ppm.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probes = [say("abc dExyzéß日", n) for n in (1, 2, 3, 4, 50, 200)] + ["", "日本", "q", "   "]
    raw = [p.encode() for p in probes]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    want = [[_code_length(train[lang], p) for lang in model.languages] for p in probes]
    for piece in (1 << 18, 7):
        monkeypatch.setattr(ppm, "PIECE", piece)
        assert np.allclose(model.code_lengths(data, offsets), want, rtol=1e-5, atol=1e-3)


def test_long_texts_are_coded_in_pieces(spark):
    rows = [(i, t * 30, lang) for i, (lang, t) in enumerate([("x", "the cat "), ("y", "der hund ")])]
    model = ppm.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    found = ppm.identify(spark.createDataFrame([("der hund " * 1_000_000,), ("the cat " * 100,)], "text string"), model).select("lang_pred", "score").collect()
    assert sorted(map(tuple, found)) == [("x", 1.0), ("y", 1.0)]


def test_the_sample_is_that_of_the_least_hashes(spark, monkeypatch):
    known = spark.range(3000).selectExpr("id as doc_id", "if(id % 10 = 0, 'few', 'many') as lang").union(spark.sql("select 7L, 'one'"))
    ranked = sorted(known.select("lang", F.xxhash64("doc_id").alias("h"), "doc_id").collect(), key=lambda r: (r.lang, r.h, r.doc_id))
    want = {(r.doc_id, r.lang) for lang in ("few", "many", "one") for r in [r for r in ranked if r.lang == lang][:20]}
    for spare in (4, 1, 0.01):
        monkeypatch.setattr(ppm, "SPARE", spare)
        assert {tuple(r) for r in ppm._sample(known, 20).collect()} == want


def test_held_out_accuracy(spark):
    found = queries.op5_ppm_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    judged = found.filter("held_out").join(truth, "doc_id").filter("lang is not null and lang_pred <> 'und'")
    assert judged.count() > 100 and judged.filter("lang_pred = lang").count() >= 0.98 * judged.count()


def _hash64(values, seed=42):
    """Spark's xxhash64 of texts and whole numbers, one after the other."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed=seed & (1 << 64) - 1)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def _anchors(text, k=5, s=2):
    """Anchors by looking at every k-word substring and all its s-word substrings."""
    words = []
    for w in re.split(r"[\x09-\x0D\x20]+|(?=[\u0E00-\u0EFF\u3040-\u30FF\u3400-\u9FFF\uAC00-\uD7AF])", text.lower()):
        if w and len(w) <= 32:
            words.append(_hash64([w]))
        elif w:
            words += [_hash64(w[i : i + 12]) for i in range(len(w) - 11)]
    found = []
    for i in range(len(words) - k + 1):
        inner = [_hash64(words[j : j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            found.append(_hash64([inner[0], inner[2], inner[3]]) & 0xFFFFFFFF)
    return found or ([_hash64(words) & 0xFFFFFFFF] if words else [])


def test_fingerprints_against_all_substrings(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "B", "cd", "é", "x" * 40, "日本語", "w\tz"]) for _ in range(n)) for n in (0, 1, 3, 5, 6, 30, 60) for _ in range(4)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = syncmers.fingerprints(rows).withColumn("near", syncmers.likeness("anchors", "next_anchors")).collect()
    for r in found:
        assert r.anchors == _anchors(texts[r.row.doc_id])
        a, b = set(r.anchors), set(_anchors(texts[(r.row.doc_id - 1) % len(texts)]))
        assert r.near == (len(a & b) / max(len(a), len(b)) if a or b else 1)


def test_resampling_weights_and_keys_against_counts(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["a", "bb", "C", "c", "ddd", "é"]) for _ in range(rng.randint(0, 12))) for _ in range(60)] + [None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    target = rows.filter("doc_id % 4 = 1").select("doc_id")
    found = {r.row.doc_id: r for r in resampling.resample(rows, target, 9, buckets=50).collect()}

    def buckets(text):
        h = [int(arrays.word_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0]) for w in (text or "").split()]
        two = [int(arrays.mix(np.array([(a * int(arrays._BASE) + b) % (1 << 64)], np.uint64))[0]) for a, b in zip(h, h[1:], strict=False)]
        return [x % 50 for x in h + two]

    raw, wanted = [1.0] * 50, [1.0] * 50
    for i, text in enumerate(texts):
        for b in buckets(text):
            raw[b] += 1
            wanted[b] += i % 4 == 1
    weight = {i: sum(math.log(wanted[b] / sum(wanted) / (raw[b] / sum(raw))) for b in buckets(t)) for i, t in enumerate(texts)}
    keys = {}
    for i, text in enumerate(texts):
        assert math.isclose(found[i].log_weight, weight[i], abs_tol=1e-9)
        keys[i] = found[i].key - found[i].log_weight
    order = sorted(found, key=lambda i: (-found[i].key, i))
    assert {i for i in found if found[i].selected} == set(order[:9])
    assert len(set(keys.values())) == len(texts)


# --- conversation repair --------------------------------------------------------------------

GAP = "\x20\t\n\x0b\x0c\r"
LEADS = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMED = {"u": "user", "a": "assistant"}


def _cheapest(rows):
    """Least cost with the ASCII-least letters, by dynamic programming over prefixes, and the rows that it keeps."""
    best = {"": (0, "", ())}

    def put(into, state, entry):
        if state not in into or entry[:2] < into[state][:2]:
            into[state] = entry

    def inserts(states):
        for _ in range(4):
            for state, (cost, audit, kept) in list(states.items()):
                to = "a" if state == "u" else "u"
                put(states, to, (cost + 2, audit + "I", (*kept, f"{NAMED[to]}:")))
        return states

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, kept) in inserts(best).items():
            put(after, state, (cost + 3, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            cut = fault == "truncated"
            if (state, role[:1]) in LEADS:
                put(after, LEADS[state, role[:1]], (cost + cut, audit + "K", (*kept, f"{role}:{text}")))
            to = "a" if state == "u" else "u"
            put(after, to, (cost + 2 + cut, audit + "R", (*kept, f"{NAMED[to]}:{text}")))
        best = after
    ends = inserts(best)
    return min(ends[s] for s in ("", "a") if s in ends)


def _judge(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest of damaged rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(GAP)
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, kept = _cheapest([(role, text, f) for (_, role, text), f in zip(rows, faults, strict=True)])
    counts = tuple(faults.count(f) for f in ("blank", "duplicate", "truncated"))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def _conversations():
    rng = random.Random(11)
    rows = [(None, None, None, None), (None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", None), (1, 2, None, "Yes.")]
    rows += [(2, 5, "user", "Same."), (2, 5, "user", "Same."), (2, 5, "assistant", "Other."), (2, 6, "Userlike", "x."), (3, 0, "", "Empty role.")]
    words = ["Yes.", "No!", "Why?", "cut off", "", " \t", "Fine. \n", "é.", "Sure."]
    for conv in range(10, 60):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv, turn, role, rng.choice(words) if rng.random() < 0.5 else f"{rng.random()}{rng.choice('.!?x')}"))
    for conv, size in ((70, 300), (71, 129), (72, 64), (73, 200)):
        for turn in range(size):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.8 else rng.choice(["user", "system", "assistant"])
            text = "again." if conv == 73 else rng.choice(words) if rng.random() < 0.2 else f"{conv} {turn} {'long ' * rng.randint(0, 30)}."
            rows.append((conv, turn if turn % 50 else None, role, text))
    return rows


def _damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv]
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    place = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {conv: sorted(found, key=place) for conv, found in out.items()}


@pytest.mark.parametrize("size", [1, 7, 64])
def test_repair_against_dynamic_programming(spark, tmp_path, monkeypatch, size):
    monkeypatch.setattr(turns, "SEGMENT_ROWS", size)
    rows = _conversations()
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, fault string, part int")
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == {conv: _judge(own) for conv, own in _damage(rows).items()}
    assert len(found) == len(_damage(rows))


def test_repair_of_the_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op11_conversation_repair(spark, sf).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((conv, *_judge(own))) for conv, own in _damage(rows).items())


def test_repair_of_nothing_and_its_rows(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turns.repair(rows).count() == 0
    rows = spark.createDataFrame([(1, 0, "system", "Be."), (1, 1, "assistant", "Hi."), (1, 2, "user", "cut")], rows.schema)
    kept = turns.repaired_rows(turns.repair(rows)).orderBy("part", "seq", "at").select("role", "text").collect()
    want = _cheapest([("system", "Be.", ""), ("assistant", "Hi.", ""), ("user", "cut", "truncated")])
    assert [f"{r.role}:{r.text}" for r in kept] == list(want[2])


def test_auction_prices_are_dual(spark):
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 9)
        signs, faults = [rng.choice("suax") for _ in range(n)], "".join(rng.choice("  bdt") for _ in range(n))
        rows = [(s, "", {"b": "blank", "d": "duplicate", "t": "truncated"}.get(f, "")) for s, f in zip(signs, faults, strict=True)]
        cost, letters, state = turns.auction(signs, faults, list(turns.ENDS), [turns.START])[turns.START]
        assert (cost, letters + "I" * (turns.ENDS[state] // 2)) == _cheapest(rows)[:2]
        between = turns.costs_between(signs, faults)
        assert min(between[to] + turns.ENDS[to] for to in turns.STATES) == cost


# --- hard negatives -------------------------------------------------------------------------


def _mined(rows):
    """All result rows, by scoring every row against every anchor."""
    taken = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, lab, v) in enumerate(taken):
        if i is None or i % 50:
            continue
        order = lambda r: (-r[0], r[1] is None, r[1] or 0)
        scored = [(sum(x * y for x, y in zip(v, w, strict=False)), j, m) for b, (j, m, w) in enumerate(taken) if b != a]
        best = sorted((r for r in scored if r[2] == lab), key=order)[:5]
        others = sorted((r for r in scored if r[2] != lab), key=order)
        for p in best:
            inside = [n for n in others if 50 * p[0] <= 100 * n[0] <= 95 * p[0]][:3]
            out += [(i, p[1], k, n[1], p[0], n[0]) for k, n in enumerate(inside, 1)]
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(4)
    near = lambda: [rng.gauss(1, 0.6) for _ in range(9)]
    rows = [(i, rng.randint(0, 2), near()) for i in range(400)]
    rows += [(50, 1, near()), (50, 2, near()), (350, 1, near()), (None, 1, near()), (None, 2, near()), (500, None, near()), (501, 1, None)]
    rows += [(550, 1, [float("nan")] * 9), (600, 1, [None] * 9), (650, 1, [float("inf")] * 9), (700, 2, []), (750, 2, [1.0] * 3), (800, 9, near())]
    return rows + [(1000 + i, i % 3, [1.0] * 9) for i in range(60)] + [(7, rows[7][1], rows[7][2])]


SCHEMA = "id long, label int, vector array<double>, uid string, block int"


@pytest.mark.parametrize("sizes", [(1 << 20, 8 << 20, 256, 2048, 64), (200, 5000, 3, 7, 2)])
def test_negatives_against_all_scores(spark, vectors, monkeypatch, sizes):
    for name, value in zip(("ANCHOR_BYTES", "CANDIDATE_BYTES", "TILE_ANCHORS", "TILE_CANDIDATES", "LEAF"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, value)
    rows = spark.createDataFrame([(*r, "x", 1) for r in vectors], SCHEMA).repartition(3)
    found = negatives.mine(negatives.integer_vectors(rows, "id", "label", "vector"))
    assert sorted(map(repr, map(tuple, found.collect()))) == _mined(vectors)


def test_negatives_of_empty_tables(spark):
    rows = negatives.integer_vectors(spark.createDataFrame([], SCHEMA), "id", "label", "vector")
    assert negatives.mine(rows).count() == 0


def test_strassen_is_exact(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 1)
    rng = np.random.default_rng(1)
    for n, k, m in ((1, 1, 1), (5, 3, 7), (16, 16, 16), (9, 1, 4), (13, 21, 6)):
        a, b = rng.integers(-(1 << 40), 1 << 40, (n, k)), rng.integers(-(1 << 20), 1 << 20, (k, m))
        assert (negatives.strassen(a, b) == a @ b).all()


def test_negatives_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    rows = [(r.vec_id, (r.label + 1) % 10 if r.label is not None and r.vec_id % 7 == 0 else r.label, r.embedding) for r in rows]
    found = queries.op13_hard_negatives(spark, sf)
    assert sorted(map(repr, map(tuple, found.collect()))) == _mined(rows)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]


def test_damage_codes(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    dropped = rows.filter(F.crc32(F.concat_ws(":", "conv_id", "turn")) % 20 == 0).count()
    again = rows.filter(F.crc32(F.concat_ws(":", "conv_id", "turn")) % 20 == 3).count()
    assert queries.damaged(spark, sf).count() == rows.count() - dropped + again


def test_anchors_of_a_bucket_are_judged_in_parts(monkeypatch):
    import pyarrow as pa

    from pitwall.llm.packs import arrow_schema

    rng = random.Random(4)
    passage = "".join(rng.choice("abcdef ") for _ in range(600))
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(400)) + passage[: 60 * (n % 11)] for n in range(40)]
    given = pa.record_batch({"_key": pa.array(range(40)), "_id": pa.array(range(40)), "_text": pa.array([t.encode() for t in texts])})
    packed = pa.Table.from_batches(list(suffix._deal_anchors(1, 50, 16, arrow_schema(suffix._PACKED))(iter([given]))))
    groups = [packed.filter(pa.compute.equal(packed["bucket"], b)) for b in set(packed["bucket"].to_pylist())]
    judge = suffix._judge_anchors(1, suffix.HOT, arrow_schema(suffix._ANSWERS))

    def answers():
        found, rows = defaultdict(set), 0
        for table in map(judge, groups):
            rows += table.num_rows
            for r in table.to_pylist():
                for name in ("covered", "look", "hot"):
                    found[r["key"], name] |= set(r[name])
        return found, rows

    whole, rows = answers()
    monkeypatch.setattr(suffix, "JUDGED", 50)
    parts, more = answers()
    assert parts == whole and any(whole.values()) and more == rows
