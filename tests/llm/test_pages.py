"""WARC archives, main text and exact top-k."""

import base64
import hashlib
import random

import numpy as np
import pytest

from flowloom.llm import knn, main_text, warc
from flowloom.llm.dom import read_page

PAGES = "page_id long, url string, html string, value string, path string"
FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}\r\nBad: 1", h, "v", "p") for i, h in rows], PAGES)


WARC_ROWS = [
    (1, "same"), (2, "same"), (3, "other é😀"), (4, None), (5, ""), (6, f"a {FAKE} b {FAKE}"), (7, f"a {FAKE} b {FAKE}"), (8, "WARC/1.0\r\n"), (9, "x\r\n\r\ny\r\n\r\n"),
    (10, "big " * 60_000), (11, "same\r\n\r\n"), (12, FAKE * 30),
]


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_warc_round_trip(spark, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["page_id"]: r for r in warc.archive_and_read(pages(spark, WARC_ROWS).coalesce(2)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == [i for i, _ in WARC_ROWS]
    last = {}
    for i, h in WARC_ROWS:
        last[h or ""] = i
    for i, h in WARC_ROWS:
        data, row = (h or "").encode(), got[i]
        assert row["payload_bytes"] == len(data)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode() == row["stated_digest"]
        assert (row["record_type"], row["refers_to"]) == (("response", None) if last[h or ""] == i else ("revisit", last[h or ""]))


def test_warc_nulls_repeats_empty(spark):
    got = warc.archive_and_read(pages(spark, [(None, "n"), (None, "m"), (1, "m"), (2, "k"), (2, "k")])).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in got) == [
        (0, "response", 0), (0, "revisit", 1), (1, "response", 0), (2, "response", 0), (2, "response", 0),
    ]
    assert warc.archive_and_read(pages(spark, [])).count() == 0


def article(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeioprst") for _ in range(rng.randint(2, 8)))
    line = lambda n: " ".join(word() for _ in range(rng.randint(3, n))).capitalize() + "."
    body = "".join(f"<p>{line(60)} &amp; {line(10)}</p>" for _ in range(rng.randint(2, 9)))
    title = line(8)
    menu = "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(5))
    html = f'<!DOCTYPE html><html><head><title>{title}</title><script>var t="</p>";</script></head><body><nav><ul>{menu}</ul></nav><div class="ad">{line(20)}</div><article><h1>{title}</h1>{body}</article><footer>&copy; {line(9)}</footer></body></html>'
    return html


def truth(html):
    page = read_page(html)
    return "\n".join(t for _, t in main_text._true_blocks(page))


@pytest.fixture(scope="module")
def trees(spark):
    return main_text.train(pages(spark, [(i, article(i)) for i in range(120)]), max_pages=120)


def test_main_text_held_out(spark, trees):
    rows = [(i, article(i)) for i in range(500, 560)] + [(1, None), (2, ""), (3, "plain words"), (500, article(500))]
    got = main_text.extract(pages(spark, rows), trees).collect()
    assert len(got) == len(rows)
    exact = sum(r["text"] == truth(dict(rows)[r["page_id"]]) for r in got if r["page_id"] >= 500)
    assert exact >= 0.95 * 61
    assert all(r["text"] == "" for r in got if r["page_id"] in (1, 2))


def test_main_text_other_layouts(trees):
    rng, found, wanted, right = random.Random(5), 0, 0, 0
    for seed in range(700, 760):
        page = read_page(article(seed))
        source = main_text.layout(main_text._true_blocks(page), [t for _, t in page.blocks], rng)
        marked, kept = read_page(source), {}
        for n, node in enumerate(marked.nodes):
            kept[n] = main_text.KEEP in node.tokens or (main_text.DROP not in node.tokens and kept.get(node.parent, False))
        want = [t for n, t in marked.blocks if kept[n]]
        got = main_text.main_text([source.replace(main_text.KEEP, "").replace(main_text.DROP, "")], trees)[0].split("\n")
        found, wanted, right = found + len(got), wanted + len(want), right + len(set(got) & set(want))
    assert right >= 0.95 * found and right >= 0.95 * wanted


def test_decoding_never_contradicts():
    parents = np.array([-1, 0, 1, 1, 0, 4])
    kept = main_text.decode(np.array([0.0, -5.0, 3.0, 1.0, -1.0, 2.0]), parents)
    assert kept.tolist() == [True, False, False, False, True, True]


def test_page_reader():
    page = read_page("<p>a &lt; b&nbsp;c<br>d <b>e</b><p>f<ul><li>x<li>y</ul><script>if (a<b) '</p>'</script>tail<!-- <p>no</p> --><div hidden>h")
    assert [t for _, t in page.blocks] == ["a < b c d e", "f", "x", "y", "tail", "h"]
    assert read_page("<div <p>odd</p").blocks is not None and read_page("<" * 1000).blocks == [(0, "<" * 1000)]


def test_no_pages(spark):
    assert main_text.report(pages(spark, [])).count() == 0
    assert main_text.report(pages(spark, [(1, "<p>no article</p>")])).first()["text"] == ""


def brute(rows, k, every):
    usable = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for i, v in usable:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in usable if j != i)[:k]
            out |= {(i, n, j, -s) for n, (s, j) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("n", [3, 400])
def test_knn(spark, n):
    rng = np.random.default_rng(n)
    same = [float(np.float32(x)) for x in rng.normal(size=8)]
    rows = [(i, same if i % 3 == 0 else [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(n)]
    rows += [(1000, None), (1020, [float("nan")] * 8), (1040, [1.0, None] * 4), (None, same), (1060, [1.0, 2.0]), (1080, [])]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in knn.top_k(table, k=5, every=20, pivots=4, sample=64).collect()}
    assert got == brute(rows, 5, 20)
    assert knn.top_k(table.limit(0)).count() == 0


def test_knn_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(100)]
    rows += [(7, [4.0] * 8)] * 30 + [(9, [-4.0] * 8)] * 3 + [(20, rows[20][1]), (40, [1.0] * 8)]
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    want = []
    for q in range(0, 100, 20):
        pairs = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for i, v in whole if i == q for j, w in whole if j != q)
        want += [(q, n, j, -s) for n, (s, j) in enumerate(pairs[:20], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for sample in (16, 64):
        got = sorted(tuple(r) for r in knn.top_k(table, k=20, every=20, pivots=4, sample=sample).collect())
        assert got == sorted(want)
