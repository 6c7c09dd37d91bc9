"""Near-duplicate groups: MinHash with universal hashes, banding, verification, star components.

Documents with equal shingle sets are one class; only classes are compared.  The minima of many
universal hashes are cut into bands; classes that share a band meet.  In each band every class is
compared with the smallest one (a star, not all pairs): signatures first, then the full sets.  Bands whose classes still
lie in different components get a second star around their most central class.  What is apart even then
is compared pair by pair across components, inside blocks of bounded size that pass on links only, so no
link is lost to the stars and no pairs are made.
Components come from alternating large-star and small-star
steps on stored edge tables.

Defined cases: null and blank texts have no shingles and are linked with nothing; a text of fewer words
than a shingle is one shingle; a row with null id is linked with nothing and kept; rows that repeat an
id and text share a result; different texts under one id count as one document; very long texts are hashed whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.sized import keep
from flowloom.llm.shingles import U64, mixed, shingle_hashes, text_groups, word_hashes

SHINGLE = 5
BANDS, ROWS = 24, 5
#: A link needs ``100 * common >= PERCENT * union``.
PERCENT = 85
#: Share of equal minima below which a pair is not compared in full; at a similarity of 0.85 an
#: estimate from 120 minima lies this low with a chance of about one in a million.
MIN_ESTIMATE = 0.70
#: Classes of one band that are compared with each other in one task.
BLOCK = 256
#: Bands above this size get a central star first, which saves pairs; below it all pairs are few.
CENTRED = 32

_RNG = np.random.default_rng(97)
_A = _RNG.integers(1, 2**62, BANDS * ROWS, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_B = _RNG.integers(0, 2**62, BANDS * ROWS, dtype=np.int64).astype(U64)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum of each universal hash over each non-empty set, as 32-bit values."""
    x = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(_A)), dtype=np.uint32)
    for k, (a, b) in enumerate(zip(_A, _B, strict=True)):
        out[:, k] = np.minimum.reduceat((x * a + b) >> U64(32), starts)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = signatures.reshape(-1, BANDS, ROWS).astype(U64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), rows.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key * U64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return key.view(np.int64)


_SIGNED = "doc_id long, n_shingles long, print binary, signature binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, prints, signatures = [], [], []
        for _, data, offsets in text_groups(batch.column("text")):
            words, first = word_hashes(data, offsets)
            sets = [np.unique(s) for s in shingle_hashes(words, first, SHINGLE)]
            full = [s for s in sets if len(s)]
            rows = iter(minima(full) if full else [])
            for s in sets:
                counts.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signatures.append(next(rows).tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())],
            names=["doc_id", "n_shingles", "print", "signature"],
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = []
        for _, data, offsets in text_groups(batch.column("text")):
            words, first = word_hashes(data, offsets)
            sets += [np.unique(s) for s in shingle_hashes(words, first, SHINGLE)]
        prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "print", "members"]
        )


@F.pandas_udf(T.ArrayType(T.LongType()))
def bands(signature: pd.Series) -> pd.Series:
    if not len(signature):
        return pd.Series([], dtype=object)
    return pd.Series(list(band_keys(np.frombuffer(b"".join(signature), dtype=np.uint32))))


@F.pandas_udf(T.DoubleType())
def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal minima."""
    if not len(a):
        return pd.Series([], dtype=float)
    x, y = (np.frombuffer(b"".join(s), dtype=np.uint32).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).mean(axis=1))


@F.pandas_udf(T.LongType())
def common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the intersection of two stored sets."""
    return pd.Series([len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype="int64")


def close_sizes(a: Column, b: Column) -> Column:
    """Sets of these sizes can reach the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def star_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs of a class and the smallest class of a band they share."""
    return members.filter("rep > leader").select(F.col("rep").alias("b"), F.col("leader").alias("a")).distinct()


def full_sets(documents: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, members``: the whole shingle set of each class that meets another one in a band.

    These ids grow with the corpus, so they are never broadcast; texts are shuffled once, here.
    """
    needed = keep(members.select("rep").distinct().join(classes.select("rep", "print"), "rep"))
    ids = needed.select(F.col("rep").alias("doc_id")).distinct()
    texts = documents.join(ids.hint("merge"), "doc_id").select("doc_id", "text")
    sets = texts.mapInArrow(_set_rows, "doc_id long, print binary, members binary").withColumnRenamed("doc_id", "rep")
    return keep(sets.join(needed, ["rep", "print"], "left_semi").select("rep", "members"))


def verify(pairs: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough; signatures tell which pairs are worth it."""
    side = classes.select("rep", "n_shingles", "signature")
    left, right = (side.select(*[F.col(c).alias(f"{c}_{x}") for c in side.columns]) for x in "ab")
    both = pairs.join(left, F.col("a") == F.col("rep_a")).join(right, F.col("b") == F.col("rep_b"))
    likely = both.filter(close_sizes(F.col("n_shingles_a"), F.col("n_shingles_b"))).filter(estimate("signature_a", "signature_b") >= MIN_ESTIMATE)
    likely = keep(likely.select("a", "b").distinct())
    leaders = sets.join(likely.select(F.col("a").alias("rep")).distinct(), "rep", "left_semi")
    x = leaders.select(F.col("rep").alias("a"), F.col("members").alias("set_a"))
    y = sets.select(F.col("rep").alias("b"), F.col("members").alias("set_b"))
    sizes = (F.octet_length("set_a") + F.octet_length("set_b")) / 8
    shared = likely.join(x, "a").join(y, "b").select("a", "b", sizes.cast("long").alias("n"), common("set_a", "set_b").alias("both"))
    return shared.filter(F.col("both") * 100 >= (F.col("n") - F.col("both")) * PERCENT).select("a", "b")


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``node, root``: smallest node of each component of the links ``a, b``; isolated nodes are absent.

    A large-star step hangs the larger neighbours of a node on its smallest one, a small-star step the
    smaller ones; both use aggregates and joins, never all neighbours of a node in one task.
    """
    links = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = None
    for _ in range(max_rounds):
        both = links.union(links.select("v", "u"))
        lowest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(lowest, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(lowest, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v")))
        links = keep(small.filter("u <> v").distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))


_BLOCK_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links across components in one block pair of one band; each pair is looked at in the first band it shares.

    A link joins two components, so later pairs between them need no look.
    """
    rows = rows.sort_values("rep").reset_index(drop=True)
    sig = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint32).reshape(len(rows), -1)
    keys, here = band_keys(sig), int(rows["band"].iloc[0])
    rep, root, size = rows["rep"].to_numpy(), rows["root"].to_numpy().copy(), rows["n_shingles"].to_numpy()
    sets = [np.frombuffer(m, dtype=U64) for m in rows["members"]]
    block, own = rows["block"].to_numpy(), int(rows["i"].iloc[0]) == int(rows["j"].iloc[0])
    out_a, out_b = [], []
    for k in range(len(rows) - 1):
        rest = slice(k + 1, None)
        ok = (root[rest] != root[k]) & (np.minimum(size[rest], size[k]) * 100 >= np.maximum(size[rest], size[k]) * PERCENT)
        if not own:
            ok &= block[rest] != block[k]
        at = np.flatnonzero(ok) + k + 1
        if not len(at):
            continue
        at = at[(sig[at] == sig[k]).mean(axis=1) >= MIN_ESTIMATE]
        first = (keys[at] == keys[k]).argmax(axis=1)
        for j in at[keys[k][first] == here].tolist():
            if root[j] == root[k]:
                continue
            both = len(np.intersect1d(sets[k], sets[j], assume_unique=True))
            if both * 100 >= (len(sets[k]) + len(sets[j]) - both) * PERCENT:
                out_a.append(rep[k])
                out_b.append(rep[j])
                root[root == root[j]] = root[k]
    return pd.DataFrame({"a": np.array(out_a, dtype=np.int64), "b": np.array(out_b, dtype=np.int64)})


def open_bands(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``band, rep, root, n`` of the bands whose classes still lie in different components.

    A band of two has had its only pair compared.
    """
    known = members.select("band", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("band", "rep", F.coalesce("root", "rep").alias("root"))
    known = keep(known)
    split = known.groupBy("band").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("n")).filter("r1 <> r2 AND n > 2")
    return keep(known.join(split.select("band", "n"), "band"))


def _centre(rows: pd.DataFrame) -> pd.DataFrame:
    """The class whose signature agrees most with the others of its block."""
    rows = rows.sort_values("rep")
    sig = np.frombuffer(b"".join(rows["signature"]), dtype=np.uint32).reshape(len(rows), -1)
    agree = np.zeros(len(rows))
    for column in sig.T:
        _, back, counts = np.unique(column, return_inverse=True, return_counts=True)
        agree += counts[back]
    best = int(agree.argmax())
    return rows.iloc[best : best + 1][["band", "rep", "signature"]]


def centre_pairs(opened: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of a class and the central class of a band they share, across components.

    Copies of one text may each be close to it but not to each other; the text they come from is the
    most central one.  It is found block by block, then among the centres of blocks, until one is left.
    """
    opened = opened.filter(F.col("n") > CENTRED)
    rows = opened.select("band", "rep", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")).join(classes.select("rep", "signature"), "rep")
    most = opened.agg(F.max("n")).first()[0] or 0
    while most > 1:
        cut = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        found = cut.groupBy("band", "blocks", "block").applyInPandas(
            lambda part: _centre(part).assign(blocks=-(-part["blocks"].iloc[0] // BLOCK)), "band long, rep long, signature binary, blocks long"
        )
        most = 1 if most <= BLOCK else -(-most // BLOCK)
        rows = keep(found.select("band", "rep", "blocks", "signature"))
    centres = rows.select("band", F.col("rep").alias("centre"))
    own = opened.select(F.col("band"), F.col("rep").alias("centre"), F.col("root").alias("centre_root"))
    named = keep(centres.join(own, ["band", "centre"]))
    pairs = opened.join(named, "band").filter("root <> centre_root")
    return pairs.select(F.greatest("rep", "centre").alias("b"), F.least("rep", "centre").alias("a")).distinct()


def cross_links(opened: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes that share a band and lie in different components.

    Signatures and full sets are compared where the blocks lie; only links come out, not pairs.
    """
    blocked = opened.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", "rep", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    rows = dealt.join(classes.select("rep", "n_shingles", "signature").join(sets, "rep"), "rep")
    return rows.groupBy("band", "i", "j").applyInPandas(_block_links, _BLOCK_LINKS).distinct()


def group_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per document."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    signed = keep(docs.mapInArrow(_sign, _SIGNED))
    linkable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    best = linkable.groupBy("print").agg(F.min(F.struct("doc_id", "n_shingles", "signature")).alias("m"))
    classes = keep(best.select("print", F.col("m.doc_id").alias("rep"), "m.n_shingles", "m.signature"))
    banded = classes.select("rep", F.explode(bands("signature")).alias("band"))
    shared = banded.groupBy("band").agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "leader")
    members = keep(banded.join(shared, "band"))
    sets = full_sets(docs, members, classes)
    stars = keep(verify(star_pairs(members), classes, sets))
    central = keep(verify(centre_pairs(open_bands(members, components(stars)), classes), classes, sets))
    links = stars.union(central)
    across = cross_links(open_bands(members, components(links)), classes, sets)
    roots = keep(components(links.union(across)))
    named = classes.select("print", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("print", F.coalesce("root", "rep").alias("root"))
    out = signed.select("doc_id", "n_shingles", "print").join(keep(named), "print", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one_each(documents: DataFrame) -> DataFrame:
    """The documents, all columns, without those another document of their group stands for.

    Rows that repeat an id and its text are reduced to one; other texts under one id stay with it.  Ids to leave grow with the
    corpus, so the join is by shuffle at every size.
    """
    groups = keep(group_documents(documents))
    gone = groups.filter("NOT kept").select(F.col("doc_id").alias("_gone"))
    rows = documents.select(F.struct("*").alias("_row"))
    stay = rows.join(gone.distinct().hint("merge"), F.col("_row.doc_id") == F.col("_gone"), "left_anti")
    again = keep(groups.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_again")))
    same = F.col("_row.doc_id") == F.col("_again")
    once = stay.join(again, same, "left_anti")
    repeated = stay.join(again, same, "left_semi").select("_row.*").dropDuplicates(["doc_id", "text"])
    return once.select("_row.*").unionByName(repeated)
