"""Personal data against plain patterns, disclosing terms against a count over all pairs."""

import hashlib
import math
import random
import re
from collections import defaultdict

from flowloom.llm import disclosure
from tests.llm.helpers import documents, prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain(text):
    """Base spans by the patterns as stated, with values in one spelling."""
    out = [(m.start(), 1, m.end(), m[0].lower()) for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 2, m.end(), ".".join(str(int(p)) for p in m[0].split("."))))
    for kind, pattern, low, high in ((3, CARD, 14, 19), (4, PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 4 or luhn(digits)):
                out.append((m.start(), kind, m.end(), digits))
    return sorted(out)


def words(text, base):
    """Start, end and term of every word; None for those that touch a base span or hold no term."""
    out = []
    for m in re.finditer(r"[^ \t-\r]+", text):
        core = re.search(r"[^\W_](?:.*[^\W_])?", m[0], re.S)
        touched = any(a < m.end() and b > m.start() for a, _, b, _ in base)
        if touched or not core or len(core[0]) < 3 or not any(c.isalpha() for c in core[0]):
            out.append((m.start(), m.end(), None))
        else:
            out.append((m.start() + core.start(), m.start() + core.end(), core[0].lower()))
    return out


def expected(rows, min_texts=3, share=0.9, min_bits=3.0):
    texts = {t or "" for _, t in rows}
    held, near, beside, holding, beginnings = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for t in texts:
        base = plain(t)
        ws = words(t, base)
        for _, _, term in words(t, []):
            if term:
                holding[term].add(t)
        for a, k, b, v in base:
            c = (k, v)
            held[c].add(t)
            raw = [m.span() for m in re.finditer(r"[^ \t-\r]+", t)]
            left = [i for i, (s, e) in enumerate(raw) if e <= a][-10:]
            right = [i for i, (s, e) in enumerate(raw) if s >= b][:10]
            for i in (*left, *right):
                if ws[i][2]:
                    near[c, ws[i][2]].add(t)
                    beside[ws[i][2]].add(t)
                    if len(ws[i][2]) > 4:
                        near[c, ws[i][2][:4] + "*"].add(t)
                        beside[ws[i][2][:4] + "*"].add(t)
    disclosed = defaultdict(dict)
    for (c, term), both in near.items():
        if term.endswith("*") or len(both) < min_texts:
            continue
        p = len(both) / len(holding[term])
        if p >= share and math.log2(p * len(texts) / len(held[c])) >= min_bits:
            wide = term[:4] + "*" if len(term) > 4 else None
            known = wide and len(near[c, wide]) < share / 2 * len(beside[wide])
            disclosed[c][term] = wide if known else None
    out = []
    for i, t in rows:
        t = t or ""
        base = plain(t)
        general = {}
        for c in {(k, v) for _, k, _, v in base}:
            for term, g in disclosed[c].items():
                general[term] = g if general.get(term, g) else None
        spans = [(a, k, b) for a, k, b, _ in base] + [(a, 5, b) for a, b, term in words(t, base) if term in general]
        text = lambda xs: ",".join(f"{disclosure.KINDS[k - 1]}:{a}:{b}" for a, k, b in sorted(xs))
        gone = [term for _, _, term in words(t, base) if term in general and not general[term]]
        kept = [term for _, _, term in words(t, base) if term in general and general[term]]
        counts = [sum(k == n for _, k, _, _ in base) for n in (1, 2, 3, 4)]
        digest = hashlib.sha256(text([(a, k, b) for a, k, b, _ in base]).encode()).hexdigest()
        out.append((i, *counts, digest, text(spans), len(kept), len(gone)))
    return out


def corpus():
    rng = random.Random(11)
    out = []
    for i in range(400):
        ws = prose(i, rng.randrange(5, 60), 120)
        if i % 20 < 4:
            person = i % 20
            at = rng.randrange(len(ws))
            ws[at:at] = [f"Reginald{person},", f"Zq{person}x" if rng.random() < 0.8 else "w5", f"p{person}@Mail.example.com", "plumber", f"Quietville-{person % 2}."]
        if i % 50 == 7:
            ws += ["+1 (743) 555-3824", f"w{i}", "10.0.0.255", "card", "4111 1111 1111 1111"]
        out.append((i, " ".join(ws)))
    out += [(1000, "Reginald0 without an address"), (1001, None), (1002, ""), (None, "x p1@mail.example.com, Reginald1"), (0, out[0][1]), (0, out[0][1])]
    out += [(2000 + k, t) for k, t in enumerate(["only@one.example", "a" * 50_000 + "@b.c", "1." * 3000, "+1" + " (" * 3000, "@" * 1000, "p2@mail.example.com" * 40])]
    return out


def test_patterns():
    cases = ["a@b.c%d@e.f.g", "a@b a@b.c", "%@-.-", "1.2.3.4.5.6.7.8.9", "999.1.1.1 1.2.3.256 01.002.3.4", "1.2.3", "..1.2.3.4..5.6.7.8"]
    cases += ["4111-1111 1111-1111", "4111111111111111 4111111111111112", "5500 0000 0000 0004 1", "+1 743 555 3824", "+12345", "+1 (2) 3.4-5 678901)", "+1+2 3456789012", "é@b.c ü.x@y.zé"]
    rng = random.Random(2)
    cases += ["".join(rng.choice("0123456789.@+ -(a)é_%\n") for _ in range(rng.randrange(80))) for _ in range(3000)]
    cases += ["".join(rng.choice("01234. -+") for _ in range(rng.randrange(60))) for _ in range(2000)]
    for text in cases:
        assert disclosure.entities(text) == plain(text), text


def test_matches_counts_over_all_pairs(spark):
    rows = corpus()
    got = [tuple(r) for r in disclosure.report(documents(spark, rows).repartition(3)).collect()]
    want = expected(rows)
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sum(r[7] + r[8] > 0 for r in got) > 40 and any(r[7] for r in got) and any(r[8] for r in got)
    # The name stays where its address does not stand.
    assert next(r for r in got if r[0] == 1000)[6] == ""


def test_sanitised_texts(spark):
    rows = corpus()
    found = disclosure.find_disclosures(documents(spark, rows), texts=True).collect()
    assert len(found) == len(rows)
    for r in found:
        assert not plain(r.text) or r.doc_id >= 2000, r.text
        if r.doc_id in range(0, 400, 20):
            assert "[email]" in r.text and "Reginald0" not in r.text
    assert next(r for r in found if r.doc_id == 1).text.count("regi*") + next(r for r in found if r.doc_id == 21).text.count("regi*") >= 1


def test_frequent_entities_disclose_nothing(spark):
    rows = [(i, f"footer{i % 3} support desk help@all.example {' '.join(prose(i, 8))}") for i in range(90)]
    got = disclosure.report(documents(spark, rows)).collect()
    assert all(r.n_email == 1 and r.n_generalised + r.n_removed == 0 for r in got)


def test_empty_table(spark):
    assert disclosure.report(documents(spark, [])).count() == 0


def test_query_over_the_small_table(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in entry.queries()["op13_disclosure"](spark, sf).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected(rows)))
    assert sum(sum(r[1:5]) for r in got) > 5
