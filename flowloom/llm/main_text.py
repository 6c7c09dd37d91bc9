"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

Every block element of a page gets features of its subtree (text, density, links, sentences), of the
words in its attributes and those of its ancestors, of its depth and of its siblings.  Boosted trees,
trained in Spark, give each node the odds that its subtree holds main text.  Decoding picks the most
likely labels of a page under one rule: nothing below a rejected element is kept.

Training pages come from the table itself, a bounded sample: the semantic article of a page is taken as
true, and the same text is set in other page layouts with menus, notices, adverts, sidebars, forms and
comments around and inside it, so that the trees do not depend on one layout.

Defined cases: null or empty html gives an empty text; a page without an article may give an empty
text; text outside any element counts as the root's; rows that repeat are each reported; without pages
to train on no text is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.sized import keep
from flowloom.llm.dom import INLINE, Page, read_page

#: Element kinds that are features of their own.
TAGS = (
    "article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "table", "td", "nav", "header", "footer", "aside", "form",
    "blockquote", "pre", "figure", "body",
)
#: Words of class, id and role, by what they usually mark.
WORDS = {
    "article": "article post entry story content body main text blog prose copy",
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs links pagination pager toc tabs",
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promoted banner adsense dfp commercial",
    "side": "sidebar side widget widgets aside related recommended more popular trending rail teaser",
    "foot": "footer foot bottom copyright legal colophon imprint",
    "head": "header masthead top branding logo site title hero",
    "comment": "comment comments reply replies respond discussion disqus thread feedback",
    "notice": "cookie cookies notice consent alert popup modal newsletter subscribe subscription gdpr overlay toast message warning",
    "share": "share sharing social follow twitter facebook",
    "form": "form login search signup contact",
    "meta": "meta byline author date tags tag category info",
}
GROUPS = {word: k for k, words in enumerate(WORDS.values()) for word in words.split()}
KEEP, DROP = "zzkeep", "zzdrop"


@dataclass
class Trees:
    """Boosted trees as arrays, one row per tree; leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    depth: int

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.weight)):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                low = x[rows, self.feature[t][at]] <= self.threshold[t][at]
                at = np.where(low, self.left[t][at], self.right[t][at])
            total += self.weight[t] * self.value[t][at]
        return 2 * total


def block_nodes(page: Page) -> tuple[list[int], np.ndarray]:
    """The block elements in page order and the place of each one's parent among them (-1 for the root)."""
    place, kept, parents = {}, [], []
    for n, node in enumerate(page.nodes):
        if node.tag in INLINE:
            place[n] = place[node.parent]
            continue
        parents.append(place[node.parent] if node.parent >= 0 else -1)
        place[n] = len(kept)
        kept.append(n)
    return kept, np.array(parents, dtype=np.int64)


def in_form(nodes: list, parents: np.ndarray) -> np.ndarray:
    """Whether a node is a form, button or header, or lies in one."""
    out = np.zeros(len(nodes))
    for k, node in enumerate(nodes):
        out[k] = node.tag in ("form", "button", "header", "label") or (k > 0 and out[parents[k]] > 0)
    return out


def features(page: Page) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Feature rows of the block elements, their node numbers and parents."""
    kept, parents = block_nodes(page)
    count, place = len(kept), {n: k for k, n in enumerate(kept)}
    own = np.zeros((count, 6))  # characters, blocks, sentence ends, commas, words, link elements
    for n, text in page.blocks:
        own[place[n]] += (len(text), 1, text.count(".") + text.count("!") + text.count("?"), text.count(","), text.count(" ") + 1, 0)
    links = np.zeros(count)
    for node in page.nodes:
        if node.tag == "a":
            p = node.parent
            while page.nodes[p].tag in INLINE:
                p = page.nodes[p].parent
            links[place[p]] += 1
    own[:, 5] = links
    total, size = own.copy(), np.ones(count)
    for k in range(count - 1, 0, -1):
        total[parents[k]] += total[k]
        size[parents[k]] += size[k]
    nodes = [page.nodes[n] for n in kept]
    tags = np.zeros((count, len(TAGS)))
    mine = np.zeros((count, len(WORDS)))
    above = np.zeros((count, len(WORDS)))
    in_tag = np.zeros((count, 4))
    depth = np.zeros(count)
    siblings, position, alike, side_text = np.ones(count), np.zeros(count), np.zeros(count), np.zeros(count)
    children: list[list[int]] = [[] for _ in range(count)]
    for k, node in enumerate(nodes):
        if node.tag in TAGS:
            tags[k, TAGS.index(node.tag)] = 1
        for word in node.tokens:
            if word in GROUPS:
                mine[k, GROUPS[word]] += 1
        if k:
            p = parents[k]
            children[p].append(k)
            above[k] = np.maximum(above[p], mine[p])
            in_tag[k] = in_tag[p]
            depth[k] = depth[p] + 1
            for j, tag in enumerate(("article", "nav", "aside", "footer")):
                in_tag[k, j] = max(in_tag[k, j], nodes[p].tag == tag)
    for group in children:
        for i, k in enumerate(group):
            siblings[k], position[k] = len(group), i / len(group)
            alike[k] = sum(nodes[j].tag == nodes[k].tag for j in group) / len(group)
            side_text[k] = sum(own[j, 0] for j in group)
    chars = total[:, 0]
    whole = max(1.0, chars[0])
    parent_share = np.where(parents >= 0, chars / np.maximum(1, chars[np.maximum(parents, 0)]), 1.0)
    shape = np.column_stack(
        [np.log1p(chars), np.log1p(own[:, 0]), chars / whole, parent_share, chars / size, total[:, 2] / np.maximum(1, total[:, 4]), total[:, 3] / np.maximum(1, total[:, 4]),
         total[:, 5] / np.maximum(1, total[:, 4]), total[:, 5] / size, chars / np.maximum(1, total[:, 1]), np.log1p(total[:, 1]), np.log1p(size), depth, np.log1p(siblings),
         position, alike, np.log1p(side_text), np.log1p(total[:, 2])]
    )
    against = [k for k, name in enumerate(WORDS) if name not in ("article", "head", "meta")]
    named = np.column_stack(
        [mine[:, against].max(1), above[:, against].max(1), np.maximum(in_tag[:, 0], above[:, 0]), in_tag[:, 1:].max(1), in_form(nodes, parents)]
    )
    return np.hstack([shape, named, in_tag, tags, mine, above]), kept, parents


def decode(odds: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Most likely labels of which no kept element lies below a rejected one."""
    gain = odds.copy()
    gain[0] = 0.0
    for k in range(len(gain) - 1, 0, -1):
        gain[parents[k]] += max(0.0, gain[k])
    kept = np.zeros(len(gain), dtype=bool)
    kept[0] = True
    for k in range(1, len(gain)):
        kept[k] = kept[parents[k]] and gain[k] > 0
    return kept


def main_text(pages: list[str], trees: Trees | None) -> list[str]:
    """Main texts of several pages."""
    if trees is None or not pages:
        return [""] * len(pages)
    read = [read_page(p) for p in pages]
    rows = [features(p) for p in read]
    odds = np.split(trees.odds(np.vstack([r[0] for r in rows])), np.cumsum([len(r[0]) for r in rows])[:-1])
    out = []
    for page, (_, nodes, parents), value in zip(read, rows, odds, strict=True):
        label = decode(value, parents)
        good = {n for n, k in zip(nodes, label, strict=True) if k}
        out.append("\n".join(text for n, text in page.blocks if n in good))
    return out


# ---------------------------------------------------------------- training pages


def _true_blocks(page: Page) -> list[tuple[str, str]] | None:
    """Tag and text of the blocks in the page's only article, or ``None``."""
    articles = [n for n, node in enumerate(page.nodes) if node.tag == "article"]
    if len(articles) != 1:
        return None
    inside = set()
    for n, node in enumerate(page.nodes):
        if n == articles[0] or node.parent in inside:
            inside.add(n)
    return [(page.nodes[n].tag, text) for n, text in page.blocks if n in inside]


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def layout(blocks: list[tuple[str, str]], prose: list[str], rng: random.Random) -> str:
    """The blocks as the main text of a page of random layout; marks in class attributes tell the truth.

    ``prose`` is text of the same kind as the main text, for the parts that must be rejected.
    """

    def pick(words: str) -> str:
        return rng.choice(WORDS[words].split())

    def some(n: int) -> str:
        return _escape(" ".join(rng.choice(prose).split()[: rng.randint(2, n)]))

    def drop(tag: str, words: str, body: str, bare: float = 0.2) -> str:
        name = "" if rng.random() < bare and tag != "div" else f"{pick(words)}-{pick(words)} "
        return f'<{tag} class="{name}{DROP}">{body}</{tag}>'

    def items(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{some(3)}</a></li>' for _ in range(rng.randint(2, n))) + "</ul>"

    def paragraphs(n: int) -> str:
        return "".join(f"<p>{some(40)}</p>" for _ in range(rng.randint(1, n)))

    def comments() -> str:
        each = "".join(f'<div class="{pick("comment")}"><b>{some(2)}</b>{paragraphs(2) if rng.random() < 0.7 else some(30)}</div>' for _ in range(rng.randint(1, 5)))
        return drop(rng.choice(["section", "div", "ol", "aside"]), "comment", f"<h3>{some(3)}</h3>{each}", 0.0)

    def advert() -> str:
        return drop(rng.choice(["div", "div", "aside"]), "advert", rng.choice([some(20), paragraphs(2), f'<a href="/y">{some(8)}</a>']), 0.0)

    def notice() -> str:
        return drop(rng.choice(["div", "section", "aside", "p"]), "notice", rng.choice([some(25), f"<p>{some(25)}</p><button>{some(3)}</button>"]), 0.0)

    def side() -> str:
        return drop(rng.choice(["aside", "div", "section"]), "side", f"<h3>{some(4)}</h3>" + rng.choice([items(6), paragraphs(3)]))

    def form() -> str:
        return drop("form", "form", f"<label>{some(4)}</label><input name=q><p>{some(12)}</p><button>{some(2)}</button>")

    def menu() -> str:
        return drop(rng.choice(["nav", "div", "ul"]), "menu", items(8))

    def share() -> str:
        return drop("div", "share", items(3))

    body = []
    for tag, text in blocks:
        tag = tag if tag in ("h1", "p") else "p"
        if tag == "p" and rng.random() < 0.15:
            tag = rng.choice(["h2", "blockquote", "li", "p", "pre"])
        inner = _escape(text)
        if rng.random() < 0.15:
            cut = inner.find(" ", len(inner) // 2)
            if cut > 0 and "&" not in inner[max(0, cut - 6) : cut + 6]:
                inner = f'{inner[:cut]} <a href="/z">{inner[cut + 1 :]}</a>'
        body.append(f"<ul><li>{inner}</li></ul>" if tag == "li" else f"<{tag}>{inner}</{tag}>")
        if rng.random() < 0.06:
            body.append(rng.choice([advert, share, side, notice, form])())
    kind = rng.random()
    tag = rng.choice(["article", "article", "main", "section", "div", "div"])
    name = "" if tag in ("article", "main") and kind < 0.6 else f"{pick('article')}-{pick('article')} "
    article = f'<{tag} class="{name}{KEEP}">{"".join(body)}</{tag}>'
    if rng.random() < 0.3:
        article = f'<div class="{pick("article")} {KEEP}">{article}{comments() if rng.random() < 0.5 else ""}</div>'
    head = drop(rng.choice(["header", "div"]), "head", f"<a href='/'>{some(3)}</a>" + (f"<p>{some(8)}</p>" if rng.random() < 0.5 else ""))
    foot = drop(rng.choice(["footer", "footer", "div"]), "foot", rng.choice([f"&copy; {some(12)}", f"<p>{some(20)}</p>{items(4)}"]))
    before = [part() for part in (menu, notice, advert, form) if rng.random() < 0.5]
    after = [part() for part in (comments, side, advert, share, form, menu) if rng.random() < 0.4]
    rng.shuffle(before)
    rng.shuffle(after)
    inner = "".join([*before, article, *after])
    if rng.random() < 0.4:
        inner = f'<div class="{rng.choice(["wrapper", "container", "page", "row", "layout"])}">{inner}</div>'
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{head if rng.random() < 0.7 else ''}{inner}{foot if rng.random() < 0.9 else ''}</body></html>"


def _labelled(page: Page, article_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels; a mark holds for what lies below, ancestors of kept text count as kept."""
    marks = [KEEP if KEEP in n.tokens or (article_only and n.tag == "article") else DROP if DROP in n.tokens else "" for n in page.nodes]
    for node in page.nodes:
        node.tokens = tuple(t for t in node.tokens if t not in (KEEP, DROP))
    x, kept, parents = features(page)
    state = [""] * len(kept)
    for k, n in enumerate(kept):
        state[k] = marks[n] or (state[parents[k]] if k else "")
    label = np.array([s == KEEP for s in state], dtype=float)
    for k in range(len(kept) - 1, 0, -1):
        label[parents[k]] = max(label[parents[k]], label[k])
    return x[1:], label[1:]


def training_rows(pages: DataFrame, max_pages: int, variants: int) -> DataFrame:
    """``x, label`` per block element of at most ``max_pages`` pages (by hash of id and html) and their layouts."""
    chosen = keep(pages.select(F.xxhash64("page_id", "html").alias("seed"), "html").filter("html IS NOT NULL").orderBy("seed").limit(max_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, labels = [], []
            for seed, source in zip(batch.column("seed").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page, rng = read_page(source), random.Random(seed)
                blocks = _true_blocks(page)
                if not blocks:
                    continue
                prose = [text for _, text in page.blocks]
                made = [(page, True), *((read_page(layout(blocks, prose, rng)), False) for _ in range(variants))]
                for item, article_only in made:
                    x, y = _labelled(item, article_only)
                    rows += x.tolist()
                    labels += y.tolist()
            yield pa.RecordBatch.from_pydict({"x": pa.array(rows, pa.list_(pa.float64())), "label": pa.array(labels, pa.float64())})

    spread = chosen.repartition(chosen.sparkSession.sparkContext.defaultParallelism)
    return keep(spread.mapInArrow(run, "x array<double>, label double"))


def train(pages: DataFrame, max_pages: int = 400, variants: int = 3, rounds: int = 40, depth: int = 5) -> Trees | None:
    """Fit boosted trees on a bounded sample of pages; ``None`` if no page has an article."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rows = training_rows(pages, max_pages, variants)
    seen = rows.agg(F.count_distinct("label")).first()[0]
    if seen < 2:
        return None
    fitted = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, maxBins=32, seed=7).fit(rows.select(array_to_vector("x").alias("features"), "label"))
    parts = []
    for tree in fitted.trees:
        feature, threshold, left, right, value = [], [], [], [], []

        def visit(node) -> int:
            k = len(feature)
            for column, item in ((feature, 0), (threshold, math.inf), (left, k), (right, k), (value, node.prediction())):
                column.append(item)
            if node.subtreeDepth() > 0:
                feature[k], threshold[k] = node.split().featureIndex(), node.split().threshold()
                left[k] = visit(node.leftChild())
                right[k] = visit(node.rightChild())
            return k

        visit(tree._call_java("rootNode"))
        parts.append((feature, threshold, left, right, value))
    width = max(len(p[0]) for p in parts)

    def table(k: int, kind) -> np.ndarray:
        out = np.zeros((len(parts), width), dtype=kind)
        for t, p in enumerate(parts):
            out[t, : len(p[k])] = p[k]
        return out

    return Trees(table(0, np.int64), table(1, float), table(2, np.int64), table(3, np.int64), table(4, float), np.array(fitted.treeWeights), depth)


def extract(pages: DataFrame, trees: Trees | None, group: int = 64) -> DataFrame:
    """``page_id, url, text`` per page, from its whole html."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, group):
                part = batch.slice(at, group)
                texts = main_text([h or "" for h in part.column("html").to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")


def report(pages: DataFrame, **options) -> DataFrame:
    found = extract(pages, train(pages, **options))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
