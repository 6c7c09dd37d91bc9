"""Benchmark decontamination with a distributed positional inverted index.

The corpus counts of all benchmark terms choose the two rarest positions of each benchmark window.
Postings of the rarest terms (document, position, words around it) are stored.  Shifted by the term's
offset in the item they are intersected with the second rarest term, exactly or within a few words,
and what is left is compared word by word.  Texts are read for the counts, the index and the word
counts of the result, and never shuffled.  Terms are matched under Unicode's lower case, a coarser rule
than A-Z that cannot lose a match; the final comparison is exact.  DataFrame functions only.

Defined cases: null texts have no words; an item with fewer words than a window is one window;
items without words match nothing; a null item id is shown as ``null``; repeated documents are each
reported; repeated items count once by id; empty tables give empty or all-clean results.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.sized import keep

#: Everything between words, after lower-casing A-Z.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before lower-casing.
SEPARATOR_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(lowered: Column) -> Column:
    """Words of a lower-cased text; null gives none."""
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATOR, -1), "")


def words_as_written(text: Column) -> Column:
    """The same words in their own letter case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR_ANY_CASE, -1), "")


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows equal in id and text get equal results, so id and text hash are key enough."""
    return documents.select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("_h"), F.col("text").alias("text"))


def runs(documents: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """Runs of consecutive windows of an item that share their two rarest positions, by corpus counts.

    ``item, len`` (window length), ``part`` (the words the run covers), ``k1, k2`` (places of the
    rarest and second rarest word in it) and ``term``, the rarest word, lower-cased.
    """
    items = keep(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(ascii_lower(F.col("text"))).alias("iw"))
        .filter(F.size("iw") > 0)
        .distinct()
    )
    vocabulary = keep(items.select(F.explode("iw").alias("term")).select(F.lower("term").alias("term")).distinct())
    counted = documents.select(F.explode(words(F.lower("text"))).alias("term")).join(vocabulary, "term", "left_semi")
    frequency = keep(counted.groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    length = F.least(F.size("iw"), F.lit(window))
    starts = items.withColumn("len", length).withColumn("w", F.explode(F.sequence(F.lit(0), F.size("iw") - length)))
    spots = starts.withColumn("q", F.explode(F.sequence(F.col("w"), F.col("w") + F.col("len") - 1)))
    spots = spots.withColumn("term", F.lower(F.element_at("iw", F.col("q") + 1)))
    by_rarity = Window.partitionBy("item", "iw", "w").orderBy(F.coalesce("n", F.lit(0)), "q")
    ranked = spots.join(frequency, "term", "left").withColumn("rank", F.row_number().over(by_rarity)).filter("rank <= 2")
    chosen = ranked.groupBy("item", "iw", "w", "len").agg(F.min_by("q", "rank").alias("q1"), F.max_by("q", "rank").alias("q2"))
    joined = chosen.groupBy("item", "iw", "len", "q1", "q2").agg(F.min("w").alias("lo"), F.max("w").alias("hi"))
    return keep(
        joined.select(
            "item", "len", F.expr("slice(iw, lo + 1, hi - lo + len)").alias("part"), (F.col("q1") - F.col("lo")).alias("k1"),
            (F.col("q2") - F.col("lo")).alias("k2"), F.lower(F.element_at("iw", F.col("q1") + 1)).alias("term"),
        )
    )


def build_index(documents: DataFrame, terms: DataFrame, window: int, block_terms: int = 500_000) -> DataFrame:
    """Stored postings of ``terms``: document, position and the words up to a window's length around it.

    The neighbourhood lets lists of further terms be intersected without the texts.  Terms are sent to
    all tasks in blocks of at most ``block_terms``, which bounds what is broadcast; one block is the rule.
    """
    blocks = max(1, -(-terms.count() // block_terms))
    docs = documents.select("doc_id", "_h", words_as_written(F.col("text")).alias("w"))
    each = docs.select("doc_id", "_h", "w", F.posexplode("w").alias("pos", "word")).withColumn("term", F.lower("word"))
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    parts = []
    for b in range(blocks):
        block = terms.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b)
        found = each.join(F.broadcast(block), "term")
        near = F.transform(F.slice("w", first + 1, F.col("pos") + window - first), ascii_lower)
        parts.append(found.select("term", "doc_id", "_h", "pos", first.alias("from"), near.alias("near")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return keep(out)


def intersect(index: DataFrame, wanted: DataFrame, slop: int) -> DataFrame:
    """Postings of rarest words whose second word is where the run has it, or within ``slop`` words of that.

    ``starts`` lists the document positions at which whole windows match, word by word.
    """
    joined = index.join(wanted, "term")
    at = F.col("pos") - F.col("k1") - F.col("from")
    second = F.element_at("part", F.col("k2") + 1)
    low = F.greatest(at + F.col("k2") - slop, F.lit(0))
    close = F.array_contains(F.slice("near", low + 1, F.greatest(at + F.col("k2") + slop + 1 - low, F.lit(0))), second)
    shifted = joined.withColumn("at", at).filter(close)
    starts = F.expr(
        "transform(filter(sequence(0, size(part) - len), k -> k <= k1 AND k1 < k + len AND at + k >= 0"
        " AND slice(near, at + k + 1, len) = slice(part, k + 1, len)), k -> from + at + k)"
    )
    agrees = (F.col("at") + F.col("k2") >= 0) & (F.get("near", F.greatest(F.col("at") + F.col("k2"), F.lit(0))) == second)
    return shifted.select("doc_id", "_h", "item", "len", F.when(agrees, starts).otherwise(F.array().cast("array<int>")).alias("starts"))


def find_matches(documents: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 4) -> DataFrame:
    """Per document with any exact or proximity match: hit words, items hit, items near.

    Columns ``doc_id, _h`` (hash of the text), ``n_hit, items`` (sorted strings), ``spans`` (start and
    length of matching windows), ``near_items`` (items of which the two rarest words of a window lie
    within ``slop`` words of their distance there; exact matches are among them).
    """
    docs = _keyed(documents)
    wanted = runs(docs, benchmark, window)
    index = build_index(docs, keep(wanted.select("term").distinct()), window)
    hits = intersect(index, wanted, slop).withColumn("start", F.explode_outer("starts"))
    exact = F.col("start").isNotNull()
    grouped = hits.groupBy("doc_id", "_h").agg(
        F.array_sort(F.collect_set(F.when(exact, F.struct("start", F.col("len").alias("n"))))).alias("spans"),
        F.array_sort(F.collect_set(F.when(exact, F.col("item")))).alias("items"),
        F.array_sort(F.collect_set("item")).alias("near_items"),
    )
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1))))
    return grouped.select("doc_id", "_h", F.size(covered).cast("long").alias("n_hit"), "items", "spans", "near_items")


def report(documents: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 4) -> DataFrame:
    """One row per document with word counts, hit words and the items found."""
    matches = keep(find_matches(documents, benchmark, window, slop))
    docs = documents.select(F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("_h"), F.size(words(F.lower("text"))).cast("long").alias("n_words"))
    joined = docs.join(matches, docs["doc_id"].eqNullSafe(matches["doc_id"]) & (docs["_h"] == matches["_h"]), "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return joined.select(
        docs["doc_id"], "n_words", hit.alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.coalesce("items", none)), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
        F.size(F.coalesce("near_items", none)).cast("long").alias("n_near_items"),
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, all columns, in which no benchmark window occurs."""
    matches = find_matches(documents, benchmark, window).filter("n_hit > 0").select(F.col("doc_id").alias("_m_id"), F.col("_h").alias("_m_h"))
    rows = documents.select(F.struct("*").alias("_row"), F.xxhash64("text").alias("_h"))
    clean = rows.join(matches, F.col("_row.doc_id").eqNullSafe(F.col("_m_id")) & (F.col("_h") == F.col("_m_h")), "left_anti")
    return clean.select("_row.*")
