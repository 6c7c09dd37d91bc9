"""Periodic runs against a scan of all periods."""

import hashlib
import random
import re
import zlib

from flowloom.llm import periodic_runs
from tests.llm.helpers import documents, prose


def scan(words, least=12):
    """Every maximal stretch of each period, smallest periods only."""
    out, n = [], len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            size = i + p - s
            smaller = any(all(words[k] == words[k + q] for k in range(s, s + size - q)) for q in range(1, p))
            if size >= max(least, 2 * p) and not smaller:
                out.append((s, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, periodic=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if periodic and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = scan(words)
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + size for s, size, p in found)]
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{size},{p}\n" for s, size, p in found)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed), sha(" ".join(kept)))


def test_runs_of_random_words():
    rng = random.Random(3)
    for _ in range(600):
        n = rng.randrange(0, 60)
        words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(n)]
        if n > 10 and rng.random() < 0.5:
            a, p = rng.randrange(n), 1 + rng.randrange(n // 2)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        for least in (2, 12):
            assert periodic_runs.find_runs(words, least) == sorted(scan(words, least)), words


def test_nested_and_neighbouring_runs():
    inner = [1, 1, 1, 1, 1, 1, 2]
    words = inner * 5 + [7] * 13 + [8, 9] * 6
    assert periodic_runs.find_runs(words) == sorted(scan(words)) and len(scan(words)) == 3


def test_long_texts_take_time_in_proportion():
    square = [i % 5000 for i in range(30_000)]
    assert periodic_runs.find_runs(square) == [(0, 30_000, 5000)]
    assert periodic_runs.find_runs([0] * 30_000) == [(0, 30_000, 1)]


def texts():
    rng = random.Random(5)
    out = {None: "a b " * 12, 1: None, 2: "", 3: " \t\n ", 4: "one", 5: "x " * 11, 6: "x " * 12, 7: "x\x0by\x0cz\r\n" * 4, 8: "a\xa0b " * 13}
    for i in range(9, 150):
        words = prose(i, rng.randrange(0, 90), 3 if i % 3 == 0 else 40)
        out[i] = rng.choice([" ", "  ", "\n"]).join(words * rng.choice([1, 1, 2, 3]))
    out[150] = " ".join(prose(150, 300, 400) * 2 + prose(151, 50))
    return out


def test_report_matches_scan(spark):
    rows = list(texts().items())
    rows += [rows[40], (40, "again " * 20)]  # a repeated row and a repeated id
    for periodic in (True, False):
        got = sorted(map(repr, (tuple(r) for r in periodic_runs.report(documents(spark, rows).repartition(3), periodic).collect())))
        want = sorted(repr((i, *expected(i, t, periodic))) for i, t in rows)
        assert got == want


def test_empty_table(spark):
    assert periodic_runs.report(documents(spark, []), True).count() == 0


def test_query_over_the_small_table(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["op12_periodic_runs"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    short = [r for r in rows if len(r.text or "") < 3000]
    assert len(short) > 100 and sum(got[r.doc_id][0] > 0 for r in short) > 5
    for r in short:
        assert got[r.doc_id] == expected(r.doc_id, r.text), r.doc_id
