"""Near duplicates, token store, toxicity and licences."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowloom.llm import licenses, near_dedup, token_store, toxicity
from flowloom.llm.near_dedup import components
from tests.llm.helpers import documents, prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def shingles(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_rows():
    rows, k = [], 0
    for seed in range(6):
        base = prose(seed, 200)
        for step in range(12):
            words = list(base)
            for j in range(step):
                words[15 * j + 7] = f"new{seed}_{j}"  # a chain: neighbours link, ends do not
            rows.append((k, " ".join(words)))
            k += 1
    rows += [(k, rows[0][1]), (k + 1, rows[0][1].upper()), (k + 2, None), (k + 3, " \t"), (k + 4, "Two words"), (k + 5, "two  WORDS"), (k + 6, "two other")]
    return rows + [(k + 7, " ".join(prose(50, 40_000)))]


def test_near_groups(spark):
    rows = near_rows()
    want = brute_groups(rows)
    got = near_dedup.group_documents(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_crossing_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "CENTRED", 2)
    rows = near_rows()
    got = near_dedup.group_documents(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_groups(rows)


def test_near_repeats_nulls_and_removal(spark):
    text = " ".join(prose(3, 60))
    docs = documents(spark, [(1, text), (1, text), (None, text), (2, text), (3, "other words here now and then"), (4, None), (5, "")])
    got = near_dedup.group_documents(docs).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True)]
    left = near_dedup.keep_one_each(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3, 4, 5]
    assert near_dedup.group_documents(documents(spark, {})).count() == 0
    # Different texts under one id are no copies of each other.
    other = documents(spark, [(1, text), (1, text), (1, "quite another text that stands under the same id"), (2, text)])
    assert sorted(r["text"][:5] for r in near_dedup.keep_one_each(other).collect()) == sorted([text[:5], "quite"])


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 103: 100}


def test_minima_estimate_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(1, 2**62, 3000).astype(np.uint64)
    a, b = values[:2000], values[200:2200]
    same = (near_dedup.minima([a, b])[0] == near_dedup.minima([a, b])[1]).mean()
    assert abs(same - 1800 / 2200) < 0.15


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 49_407), max_size=3000), st.sampled_from([8, 64, 1 << 16]))
def test_planes_round_trip(ids, block):
    old, token_store.BLOCK_IDS = token_store.BLOCK_IDS, block
    try:
        array = np.array(ids, dtype=np.uint32)
        n_planes, sizes, payload = token_store.pack(array)
        assert token_store.unpack(len(array), n_planes, sizes, payload).tolist() == ids
    finally:
        token_store.BLOCK_IDS = old


TOKENIZER, ENCODER = Tokenizer.from_file(VOCABULARY), token_store.Encoder(VOCABULARY)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from(["'ll", "'S", "<|endoftext|>", "́", "\x85", "\x1c", "İ", "Σ", " ", "ﬁ", " ", "\n"])), max_size=12))
def test_encoder_equals_whole_texts(parts):
    text = "".join(parts)
    assert ENCODER.encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_token_store(spark, monkeypatch):
    rows = [(7, "Hello world"), (3, None), (2, ""), (2, "again"), (None, "no id"), (9, " ".join(prose(1, 30_000))), (1, "ünï <|endoftext|> x")]
    got = token_store.store_and_read(documents(spark, rows), VOCABULARY).orderBy("start").collect()
    at, want = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [tuple(r) for r in got] == want
    assert token_store.store_and_read(documents(spark, {}), VOCABULARY).count() == 0


def small_model():
    grams = np.zeros((28,) * 4)
    for word in ["idiot"] * 50 + ["title"] * 40 + ["loser"] * 50 + ["good"] * 30 + ["you"] * 60:
        codes = [0, 0, 0, *(ord(c) - 96 for c in word), 0]
        for k in range(len(codes) - 3):
            grams[tuple(codes[k : k + 4])] += 1
    chance = np.full(28, 1 / 28)
    for order in range(1, 5):
        here = grams.sum(axis=tuple(range(4 - order)))
        chance = (here + 0.5 * chance) / (here.sum(axis=-1, keepdims=True) + 0.5)
    return np.log(chance).astype(np.float32).ravel()


@pytest.mark.parametrize(
    ("written", "read"),
    [("1d10t", "idiot"), ("l0$er", "loser"), ("i d i o t", "idiot"), ("l.o.s.e.r", "loser"), ("looooser", "loser"), ("goooood", "good"), ("title", "title")],
)
def test_restoring(written, read):
    assert toxicity.Restorer(small_model()).restore(f"the {written} end") == f"the {read} end"


def test_decoding_is_the_best_path():
    import itertools

    restorer = toxicity.Restorer(small_model())
    for stretch in ("1d10t", "l0$3r", "t1t1e"):
        lattice = [*restorer.lattice(stretch), [(" ", 0.0)]]
        best = None
        for path in itertools.product(*lattice):
            text, value, state = "".join(p[0] for p in path), sum(p[1] for p in path), 0
            for char in text:
                cell = state * 28 + toxicity._symbol(char)
                value, state = value + float(restorer.model[cell]), cell % toxicity.CONTEXTS
            best = max(best, (value, text)) if best else (value, text)
        assert restorer.read(stretch) == best[1].rstrip(" ")


def test_toxicity_of_hidden_words(spark):
    rows = [(i, " ".join(prose(i, 60)) + (" you idiot loser" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, "what an 1d10t and l0ser"), (1001, "nothing to see"), (1002, None), (1003, ""), (None, "you idiot")]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in toxicity.report(spark, docs, labels).collect()}
    assert len(got) == len(rows)
    wrong = [i for i in range(400) if got[i]["predicted"] != int(i % 4 == 0)]
    assert not wrong
    assert got[1000]["predicted"] == 1 and got[None]["predicted"] == 1
    assert all(got[i]["predicted"] == 0 for i in (1001, 1002, 1003))
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(400))
    left = toxicity.remove_toxic(docs, labels)
    assert left.columns == docs.columns and left.count() == len(rows) - 102


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.report(spark, documents(spark, {1: "x"}), none).collect()] == [0.0]
    one_kind = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.report(spark, documents(spark, {1: "x"}), one_kind).first()["score"] == 0.0
    assert toxicity.report(spark, documents(spark, {}), none).count() == 0


FILES = [
    (1, "a/LICENSE", "Licensed under the Apache License, Version 2.0."),
    (2, "a/b/c/x.py", "code"),
    (3, "a/b/LICENSE.txt", "Some words\nReleased under the MIT license"),
    (4, "a/y.py", "code\nAll rights reserved."),
    (5, "z.py", None),
    (6, None, "nothing"),
    (7, "a/q.py", ""),
    (7, "a/q.py", ""),
    (8, "c/d.py", "the of and a to"),
    (9, "a/bb/e.py", "of the software and the terms"),
]


def test_licences(spark):
    files = spark.createDataFrame([(*f, "extra") for f in FILES], "id long, path string, text string, dir string")
    got = sorted((r["id"], r["own"], r["licence"], r["origin"]) for r in licenses.scan(files).na.fill("-").collect())
    assert got == [
        (1, "apache-2.0", "apache-2.0", "-"), (2, "-", "mit", "a/b"), (3, "mit", "mit", "-"), (4, "proprietary", "proprietary", "-"), (5, "-", "-", "-"),
        (6, "-", "-", "-"), (7, "-", "apache-2.0", "a"), (7, "-", "apache-2.0", "a"), (8, "-", "-", "-"), (9, "-", "apache-2.0", "a"),
    ]
    assert licenses.scan(files.limit(0)).count() == 0


def test_licence_cosine_against_brute_force():
    lines = ["Licensed under the Apache License, Version 2.0.", "under the Apache License", "All rights reserved. x", "the of"]
    index = licenses.build_index(licenses.TEMPLATES, {"the": 50, "of": 40}, 100, 0.5)
    for line in lines:
        words = licenses.terms(line)
        vector = {w: index.weight.get(w, index.unseen) * words.count(w) for w in words}
        scores = []
        for name, templates in licenses.TEMPLATES.items():
            for template in templates:
                other = {w: index.weight[w] * licenses.terms(template).count(w) for w in licenses.terms(template)}
                dot = sum(v * other.get(w, 0) for w, v in vector.items())
                scores.append((dot / np.linalg.norm(list(vector.values())) / np.linalg.norm(list(other.values())), name))
        best, found = max(scores), index.best(words, 0.5)
        assert (found is None) == (best[0] < 0.5)
        assert found is None or abs(found[0] - best[0]) < 1e-9


def test_licence_cosine_uses_the_weights_of_the_corpus(spark):
    import math
    from collections import Counter

    texts = {1: "All rights reserved worldwide.", 2: "Licensed under the Apache License, Version 2.0. zyxw", 3: "All rights reserved unheardof nowhereelse never", 4: None}
    texts |= {i: "worldwide the of " + " ".join(prose(i, 12)) for i in range(10, 210)}
    files = spark.createDataFrame([(i, None, t) for i, t in texts.items()], "id long, path string, text string")
    got = {r["id"]: (r["own"], r["cosine"]) for r in licenses.scan(files).collect()}
    held = Counter(w for t in texts.values() for w in set(licenses.terms(t or "")))

    def vector(text):
        return {w: n * (math.log((len(texts) + 1) / (held[w] + 1)) + 1) for w, n in Counter(licenses.terms(text)).items()}

    for i, text in texts.items():
        v, best = vector(text or ""), (0.0, "")
        for name, lines in licenses.TEMPLATES.items():
            for other in map(vector, lines):
                dot = sum(x * other.get(w, 0) for w, x in v.items())
                best = max(best, (dot / math.hypot(*v.values(), 1e-9) / math.hypot(*other.values()), name))
        assert got[i][0] == (best[1] if best[0] >= 0.8 else None), i
        assert got[i][0] is None or abs(got[i][1] - best[0]) < 1e-9
    assert got[1][0] == "proprietary" and got[3][0] is None


def test_wrapped_headers_and_whole_licence_files(spark):
    import textwrap

    def wrapped(text, mark="", width=70):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    code = "\n".join(f"value_{i} = compute_{i}(alpha, beta)" for i in range(60))
    gpl = licenses.TEMPLATES["gpl-3.0"][0] + ", or (at your option) any later version."
    bsd = licenses.TEMPLATES["bsd-3-clause"][0] + ":"
    apache = licenses.TEMPLATES["apache-2.0"][1] + " You may obtain a copy of the License at"
    notice = "Copyright (c) 2019, Some Body\nAll rights reserved.\n\n"
    texts = {
        "gpl-3.0": [wrapped(gpl, "# ") + "\n" + code, wrapped(gpl, " ", 40) + "\n\n" + code, licenses.TEXTS["gpl-3.0"]],
        "bsd-3-clause": ["/*\n" + wrapped(bsd) + "\n*/\n" + code, notice + licenses.TEXTS["bsd-3-clause"]],
        "apache-2.0": [wrapped(apache, " * ") + "\n" + code, licenses.TEXTS["apache-2.0"]],
        "mit": ["MIT License\n\n" + notice + licenses.TEXTS["mit"], "\n".join("// " + x for x in licenses.TEXTS["mit"].splitlines()) + "\n" + code],
        "mpl-2.0": [licenses.TEXTS["mpl-2.0"]],
    }
    named = [(name, text) for name, group in texts.items() for text in group]
    rows = [(i, f"d{i}/file.txt", text) for i, (_, text) in enumerate(named)] + [(100 + i, f"d{i}/below/x.py", "plain") for i in range(len(named))]
    rows += [(1000 + i, None, "the of and to " + " ".join(prose(i, 40))) for i in range(300)]
    got = {r["id"]: r for r in licenses.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    for i, (name, text) in enumerate(named):
        assert got[i]["own"] == name, (i, text[:60])
        if text.startswith(notice) or text.startswith("MIT License") or text == licenses.TEXTS.get(name):
            assert got[100 + i]["licence"] == name, (i, text[:60])


def test_encoder_asks_for_a_word_once_and_empties_full_caches():
    encoder, texts = token_store.Encoder(VOCABULARY, cached=5), ["Alpha beta, GAMMA alpha! 12 x<y", "é É\x1cß delta's", "a b c d e f g h i j a"]
    for text in texts * 2:
        assert encoder.encode(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
        assert len(encoder.words) <= 5 and len(encoder.pieces) <= 5
    asked, encoder = [], token_store.Encoder(VOCABULARY)
    plain, encoder.words.make = encoder.words.make, lambda word: asked.append(word) or plain(word)
    encoder.encode("one two one"), encoder.encode("two three")
    assert asked == ["one", "two", "three"]
