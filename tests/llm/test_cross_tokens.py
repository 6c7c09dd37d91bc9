"""Token alignment against a plain computation over Python lists and sets."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from flowloom.llm import cross_tokens
from tests.llm.helpers import documents, prose

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def alphabet():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 1000))
    return {chr(b) if b in plain else chr(next(rest)): b for b in range(256)}


def expected(rows, models):
    """Every link of every text, one by one."""
    a, b = models
    shown = alphabet()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    groups = []
    for _, text in rows:
        own = []
        if text:
            ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text))
            raw = ([bytes(shown[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]])
            if all(b"".join(r) == (" " + text).encode() for r in raw):
                ends = []
                for r in raw:
                    at, out = 0, []
                    for x in r:
                        at += len(x)
                        out.append(at)
                    ends.append(out)
                shared, last = sorted(set(ends[0]) & set(ends[1])), 0
                for e in shared:
                    own.append(tuple([i for i, x in zip(ids[s], ends[s], strict=True) if last < x <= e] for s in (0, 1)))
                    last = e
        groups.append(own)
    links = [[(x, y) for g in own for x in g[0] for y in g[1]] for own in groups]
    counts = Counter(pair for own in links for pair in set(own))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for (i, _), own, ls in zip(rows, groups, links, strict=True):
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in own)
        digest = hashlib.sha256(text.encode()).hexdigest() if own else ""
        n_best = sum(counts[p] == highest[p[0]] for p in ls)
        out.append((i, sum(len(g[0]) for g in own), sum(len(g[1]) for g in own), len(own), len(ls), n_best, sum(counts[p] for p in ls), digest))
    return out


def texts():
    rng = random.Random(7)
    out = {None: "no id here", 1: None, 2: "", 3: " ", 4: "  two  blanks  ", 5: "▁ lower block", 6: "<|endoftext|> and <s> </s> <unk> <0x41>", 7: "tabs\tand\r\nlines\n\n\n"}
    out |= {8: "\x00\x01\x7f nul", 9: "naïve café 你好世界 \U0001f600\U0001f468‍\U0001f469", 10: "=" * 300 + " " * 200 + "-" * 77, 11: "a" * 5000, 12: "don't I'll we've 1234567 12,345.67"}
    for i in range(13, 60):
        words = prose(i, rng.randrange(1, 120), 50) + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x250), rng.randrange(0x4E00, 0x4F00)])) for _ in range(rng.randrange(1, 12))) for _ in range(20)]
        rng.shuffle(words)
        out[i] = rng.choice([" ", "  ", "\n"]).join(words)
    return out


def test_matches_single_links(spark, models):
    rows = list(texts().items())
    rows += [rows[20], (20, "other text under one id")]
    got = [tuple(r) for r in cross_tokens.report(documents(spark, rows).repartition(3), *PATHS).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows, models)))
    assert sum(r[1] > 0 for r in got) > 50 and any(r[3] < r[1] for r in got)


def test_small_batches_give_the_same(spark, models, monkeypatch):
    rows = list(texts().items())
    links = cross_tokens.align
    monkeypatch.setattr(cross_tokens, "LONG_GROUP", 1)
    first, second = cross_tokens._side(cross_tokens.ByteLevel, PATHS[0]), cross_tokens._side(cross_tokens.Pieces, PATHS[1])
    import pyarrow as pa

    ids, column = pa.array([i for i, _ in rows], pa.int64()), pa.array([t or "" for _, t in rows], pa.large_string())
    small = links(ids, column, first, second)
    monkeypatch.setattr(cross_tokens, "LONG_GROUP", 1 << 30)
    assert sorted(map(repr, small.links.to_pylist())) == sorted(map(repr, links(ids, column, first, second).links.to_pylist()))


def test_byte_level_ids_are_those_of_the_file(models):
    own = cross_tokens.ByteLevel(PATHS[0])
    chars = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x1F300, 0x1F700))
    for at in range(0, len(chars), 40):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}2 " for c in chars[at : at + 40])
        assert own.encode(text).tolist() == models[0].encode(" " + text, add_special_tokens=False).ids, at


def test_empty_table(spark):
    assert cross_tokens.report(documents(spark, []), *PATHS).count() == 0


def test_query_over_the_small_table(spark, models):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in entry.queries()["op11_cross_tokens"](spark, sf).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows, models)))
