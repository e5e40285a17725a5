"""Each stage of the pipeline on all that its predecessor kept, against brute force, and the whole run."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from pitwall.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    rng = random.Random(21)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(2, 6)))
    letters = {"x": "aeioulmn", "y": "krtszwüß"}
    prose = lambda lang, n: " ".join(word(letters[lang]) for _ in range(n))
    passage = {lang: prose(lang, 30) for lang in letters}
    texts = [(prose(lang, 40), lang) for lang in "xy" for _ in range(12)]
    texts += [(f"{prose(lang, 25)} {passage[lang]} {prose(lang, 25)}", lang) for lang in "xy" for _ in range(4)]
    for lang in "xy":
        base = prose(lang, 120).split()
        for _ in range(6):
            near = list(base)
            near[rng.randrange(120)] = word(letters[lang])
            texts.append((" ".join(near), lang))
        texts += [(" ".join(base), lang), (" ".join(base).upper(), lang)]
    rows = [(i, t, lang, "abc"[i % 3] if i % 5 else None) for i, (t, lang) in enumerate(texts)]
    rows += [(900, None, "x", "a"), (901, "", "x", "a"), (902, "12 34 !", None, "b"), (None, prose("x", 30), "x", "a")]
    # an id with a copy and a text of its own, and wholly equal rows
    rows += [(903, texts[0][0], "x", "a"), (903, prose("x", 35), "x", "a"), (904, prose("y", 35), "y", "b")]
    return rows + [(905, "liulo " * 20, "x", "c")] * 2


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pipeline")
    rows = [(*r, len(r[1] or "")) for r in _rows()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _shingles(text):
    words = _words(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def _plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(pipeline.STAGES)

    named = pipeline.materialise(stages["language ID"](spark, docs, folder), "named")
    assert named.columns == docs.columns
    known = _plain(named)
    assert set(known) <= set(_plain(docs))
    assert {r[0] for r in _plain(docs)} - {r[0] for r in known} == {900, 901, 902}

    rows = list(dict.fromkeys(known))
    sets, up = [_shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                up[top(i)] = top(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(top(i), []).append(row)
    kept = pipeline.materialise(stages["n-gram Jaccard join"](spark, named, folder), "kept")
    found = _plain(kept)
    assert [r[0] for r in found].count(903) == 1 and [r[0] for r in found].count(905) == 1
    least = {min(g, key=lambda r: (r[0] is None, r[0] or 0))[0] for g in groups.values()}
    assert {r[0] for r in found} == least and len(found) == len(groups)
    assert all(any(r in g for r in found) for g in groups.values())

    cut = pipeline.materialise(stages["suffix-array dedup"](spark, kept, folder), "cut")
    order = lambda i: 1 << 62 if i is None else i
    first = {}
    for i, text, *_ in found:
        raw = text.encode()
        for p in range(len(raw) - 49):
            first[raw[p : p + 50]] = min(first.get(raw[p : p + 50], order(i)), order(i))
    want = []
    for i, text, lang, source, _ in found:
        raw, gone = text.encode(), set()
        for p in range(len(raw) - 49):
            if first[raw[p : p + 50]] < order(i):
                gone.update(range(p, p + 50))
        left = bytes(b for p, b in enumerate(raw) if p not in gone)
        if not gone or left:
            left = left.decode("utf-8", "replace")
            want.append((i, left, lang, source, len(left)))
    assert _plain(cut) == sorted(want, key=repr)
    assert any(len(r[1]) < len(dict((x[0], x[1]) for x in found)[r[0]]) for r in want if r[0] is not None)

    mixed = pipeline.materialise(stages["mixing sources"](spark, cut, folder), "mixed")
    taken = _plain(mixed)
    assert set(taken) <= set(_plain(cut)) and max(taken.count(r) for r in set(taken)) <= 2

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, text, lang, source, _ in taken:
        ids = own.encode_ordinary(text)
        digests = (",".join(map(str, ids)).encode(), text.encode())
        want.append((i, lang, source, len(ids), *(hashlib.sha256(d).hexdigest() for d in digests)))
    assert _plain(stages["byte-level BPE"](spark, mixed, folder)) == sorted(want, key=repr)
    assert _plain(pipeline.run(spark, folder)) == sorted(want, key=repr)


def test_run_of_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_tasks_give_free_memory_back(monkeypatch):
    import pyarrow as pa

    from pitwall.llm import arrays

    given = []
    monkeypatch.setattr(arrays, "give_back", lambda: given.append(1))
    batches = arrays.giving_back(lambda part: (b for b in part))(iter([1, 2]))
    assert next(batches) == 1 and not given
    assert list(batches) == [2] and given == [1]
    for n, times in ((1, 1), (arrays.LARGE_GROUP, 2)):
        table = pa.table({"x": pa.nulls(n, pa.int64())})
        assert arrays.giving_back_group(lambda t: t.slice(0, 1))(table).num_rows == 1 and len(given) == times
    monkeypatch.undo()
    arrays.give_back()
