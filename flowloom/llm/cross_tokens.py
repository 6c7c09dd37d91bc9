"""Alignment of two tokenizers over whole texts: groups of tokens between shared ends, and links counted corpus-wide.

Each task walks its documents in batches, all columns being Arrow arrays.  Token lists are flattened, with the index of
the document of each token; byte ends are cumulative sums that start anew per document; an Acero hash join of both
tables of ends on (document, end) gives the places where both tokenizers stop, which cut the tokens into groups.  The
links of a group are all pairs of its tokens of either side; they are reduced to distinct id pairs with their
multiplicity per document and, by ``Table.group_by``, to the number of documents per pair of the batch.

A batch becomes one stored row: its distinct pairs with their partial counts, its documents, and the documents' links as
numbers of the batch's pairs, compressed.  Spark merges the partial counts of all batches, finds the highest count per
first id, and sends each batch the counts of its own pairs only; links of documents are never shuffled one by one.

Sizes are bounded by parameters: a batch closes at ``BATCH_PAIRS`` distinct pairs, ``BATCH_LINKS`` document links or
``BATCH_DOCS`` documents; a document beyond that is a batch of its own.  Long groups are reduced to distinct ids with
their counts before they are paired.

Defined cases: null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens, zeros and
an empty digest; rows that repeat count as documents each; a null id is kept; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.sized import keep
from flowloom.llm.arrow_words import slices, text_bytes, whole_texts

#: Bytes of text that are tokenized at a time.
TEXT_BYTES = 2 << 20
BATCH_PAIRS, BATCH_LINKS, BATCH_DOCS = 1 << 18, 1 << 22, 1 << 14
#: Groups with more links than this are reduced to distinct ids first.
LONG_GROUP = 256
#: A pair of ids in one number; both vocabularies must have fewer ids.
SECOND = 1 << 20

#: How the byte-level vocabulary writes bytes: visible Latin-1 characters as they are, the rest from U+0100 on.
VISIBLE = (*range(33, 127), *range(161, 173), *range(174, 256))
#: Pieces that byte-level texts are cut into before merging.  Fixed value of the public vocabulary.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_STORED = (
    "batch bigint, pairs array<bigint>, n_docs array<int>, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>,"
    " n_links array<bigint>, digests array<string>, n_pairs array<int>, payload binary"
)
_RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


class ByteLevel:
    """Ids of a byte-level BPE file; merges have the order of their ids, so ranks alone define them."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        others = iter(range(256, 512))
        shown = {chr(b) if b in VISIBLE else chr(next(others)): b for b in range(256)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(shown[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.path = path
        self.model = tiktoken.Encoding("byte level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        size = max(ranks.values()) + 1
        self.bytes = [b""] * size
        for token, i in ranks.items():
            self.bytes[i] = token

    @functools.cached_property
    def slow(self):
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.encode_special_tokens = True
        return out

    def encode(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.model.encode_to_numpy(" " + text, disallowed_special=()), dtype=np.int32)
        except BaseException as error:  # a pattern that gives up on a very long piece ends in a panic
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return np.array(self.slow.encode(" " + text, add_special_tokens=False).ids, dtype=np.int32)


class Pieces:
    """Ids of a sentencepiece model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(n)
        ]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), dtype=np.int32)


class Side(NamedTuple):
    """One tokenizer with tables of its tokens' bytes, their lengths, and its ids as text."""

    encode: object
    bytes: pa.Array
    sizes: pa.Array
    names: pa.Array


@functools.cache
def _side(kind: type, path: str) -> Side:
    made = kind(path)
    if len(made.bytes) >= SECOND:
        raise ValueError("vocabulary too large")
    return Side(made.encode, pa.array(made.bytes, pa.large_binary()), pa.array([len(x) for x in made.bytes], pa.int64()), pa.array([str(i) for i in range(len(made.bytes))]))


def _equal(tokens: list[np.ndarray], side: Side, texts: pa.Array) -> np.ndarray:
    """Which texts the tokens' joined bytes give back, behind a space."""
    data, bounds = text_bytes(texts)
    joined = np.insert(data, bounds[:-1], 0x20)
    bounds = bounds + np.arange(len(bounds))
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
    ids = pa.array(np.concatenate(tokens) if tokens else np.zeros(0, np.int32))
    made = side.bytes.take(ids)
    ends = np.concatenate([[0], np.cumsum(side.sizes.take(ids).to_numpy())])[offsets]
    have = np.frombuffer(made.buffers()[2] or b"", dtype=np.uint8)[: ends[-1]]
    if np.array_equal(ends, bounds) and np.array_equal(have, joined):
        return np.ones(len(tokens), dtype=bool)
    return np.array([np.array_equal(have[ends[k] : ends[k + 1]], joined[bounds[k] : bounds[k + 1]]) for k in range(len(tokens))], dtype=bool)


def _ends(tokens: pa.ListArray, side: Side, at: str) -> pa.Table:
    """Document, byte end within the document, and number of every token."""
    doc, sizes = pc.list_parent_indices(tokens), side.sizes.take(tokens.flatten())
    total = pc.cumulative_sum(sizes)
    before = pc.subtract(total, sizes)
    # The first token of each document starts at 0; documents here have tokens.
    base = before.take(tokens.offsets[:-1])
    return pa.table({"doc": doc, "end": pc.subtract(total, base.take(doc)), at: pa.array(np.arange(len(sizes)))})


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32)))


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: the group of each element and its place within it."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


def _links(a: np.ndarray, b: np.ndarray, a_from: np.ndarray, a_to: np.ndarray, b_from: np.ndarray, b_to: np.ndarray, doc: np.ndarray) -> pa.Table:
    """Distinct ``(doc, pair)`` with ``n``, the links of the document with that pair of ids."""
    na, nb = a_to - a_from, b_to - b_from
    short = na * nb <= LONG_GROUP
    parts = []
    group, within = _spread((na * nb)[short])
    at, bt, width = a_from[short][group], b_from[short][group], nb[short][group]
    pair = a[at + within // width].astype(np.int64) * SECOND + b[bt + within % width]
    parts.append(pa.table({"doc": doc[short][group], "pair": pair, "n": np.ones(len(pair), dtype=np.int64)}))
    for k in np.flatnonzero(~short):
        ids, n = np.unique(a[a_from[k] : a_to[k]], return_counts=True)
        others, m = np.unique(b[b_from[k] : b_to[k]], return_counts=True)
        pair = (ids.astype(np.int64)[:, None] * SECOND + others[None, :]).ravel()
        parts.append(pa.table({"doc": np.full(len(pair), doc[k]), "pair": pair, "n": (n[:, None] * m[None, :]).ravel()}))
    return pa.concat_tables(parts).group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["doc", "pair", "n"])


class Aligned(NamedTuple):
    """Alignment of some documents: a row per document and the distinct links."""

    docs: pa.Table
    links: pa.Table


def align(ids: pa.Array, texts: pa.Array, first: Side, second: Side) -> Aligned:
    """Groups, digests and links of texts; ``links.doc`` numbers the rows of ``docs``."""
    shown = texts.to_pylist()
    none = np.zeros(0, dtype=np.int32)
    tokens = [[side.encode(t) if t else none for t in shown] for side in (first, second)]
    good = np.array([bool(t) for t in shown], dtype=bool)
    for side, own in zip((first, second), tokens, strict=True):
        good &= _equal(own, side, texts)
    rows = np.flatnonzero(good)
    n = len(shown)
    counts = {name: np.zeros(n, dtype=np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    digests, links = [""] * n, pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    if len(rows):
        la, lb = _lists([tokens[0][k] for k in rows]), _lists([tokens[1][k] for k in rows])
        shared = _ends(la, first, "a").join(_ends(lb, second, "b"), keys=["doc", "end"], join_type="inner", use_threads=False)
        at, bt = shared["a"].to_numpy(), shared["b"].to_numpy()
        order = np.argsort(at)
        a_to, b_to, doc = at[order] + 1, bt[order] + 1, shared["doc"].to_numpy()[order]
        a_from, b_from = np.concatenate([[0], a_to[:-1]]), np.concatenate([[0], b_to[:-1]])
        a, b = la.flatten().to_numpy(), lb.flatten().to_numpy()
        links = _links(a, b, a_from, a_to, b_from, b_to, rows[doc])
        groups = np.bincount(doc, minlength=len(rows))
        counts["n_a"][rows], counts["n_b"][rows] = np.diff(la.offsets.to_numpy()), np.diff(lb.offsets.to_numpy())
        counts["n_groups"][rows] = groups
        counts["n_links"][rows] = np.bincount(doc, weights=(a_to - a_from) * (b_to - b_from), minlength=len(rows)).astype(np.int64)

        def named(flat: pa.Array, side: Side, ends: np.ndarray) -> pa.Array:
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            return pc.binary_join(pa.ListArray.from_arrays(offsets, side.names.take(flat)), ",")

        each = pc.binary_join_element_wise(named(la.flatten(), first, a_to), named(lb.flatten(), second, b_to), "|")
        offsets = pa.array(np.concatenate([[0], np.cumsum(groups)]).astype(np.int32))
        for k, text in zip(rows, pc.binary_join(pa.ListArray.from_arrays(offsets, each), ";"), strict=True):
            digests[k] = hashlib.sha256(text.as_buffer()).hexdigest()
    return Aligned(pa.table({"doc_id": ids, **counts, "digest": pa.array(digests, pa.string())}), links)


def _packed(batch: int, parts: list[Aligned]) -> pa.RecordBatch:
    """One stored row of a batch: links as numbers of its distinct pairs, grouped by document."""
    docs = pa.concat_tables([p.docs for p in parts])
    shift = np.cumsum([0, *[p.docs.num_rows for p in parts]])
    doc = np.concatenate([p.links["doc"].to_numpy() + s for p, s in zip(parts, shift[:-1], strict=True)])
    pair = np.concatenate([p.links["pair"].to_numpy() for p in parts])
    times = np.concatenate([p.links["n"].to_numpy() for p in parts])
    merged = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
    pairs, n_docs = merged["pair"].to_numpy(), merged["count_all"].to_numpy()
    number = np.searchsorted(pairs, pair)
    order = np.lexsort((number, doc))
    number, n_pairs = number[order], np.bincount(doc, minlength=docs.num_rows)
    # Numbers rise within a document; steps are small and compress well.
    steps = np.diff(number, prepend=0).astype(np.int32)
    payload = zstandard.ZstdCompressor(level=1).compress(_planes(steps) + times[order].astype("<i8").tobytes())
    one = lambda values, kind: pa.array([values], pa.list_(kind))
    own = lambda name: docs[name].to_pylist()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([batch], pa.int64()), one(pairs, pa.int64()), one(n_docs.astype(np.int32), pa.int32()), one(own("doc_id"), pa.int64()),
            *[one(own(c), pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], one(own("digest"), pa.string()),
            one(n_pairs.astype(np.int32), pa.int32()), pa.array([payload], pa.binary()),
        ],
        names=["batch", "pairs", "n_docs", "doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests", "n_pairs", "payload"],
    )


def _planes(steps: np.ndarray) -> bytes:
    """Bytes of 32-bit numbers, all lowest ones first."""
    return np.ascontiguousarray(steps.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(payload: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload, max_output_size=12 * n + 64)
    steps = np.ascontiguousarray(np.frombuffer(data[: 4 * n], dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()
    return np.cumsum(steps, dtype=np.int64), np.frombuffer(data[4 * n :], dtype="<i8")


def align_batches(documents: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """One row per batch of documents: pairs with partial document counts, documents, and packed links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _side(ByteLevel, first_path), _side(Pieces, second_path)
        task, made, parts, seen, links, docs = TaskContext.get().partitionId(), 0, [], 0, 0, 0
        for batch in batches:
            for part in slices(batch, most=TEXT_BYTES):
                found = align(part.column("doc_id"), whole_texts(part.column("text")), first, second)
                parts.append(found)
                links, docs = links + found.links.num_rows, docs + found.docs.num_rows
                seen += len(found.links["pair"].unique())
                if seen > BATCH_PAIRS:
                    seen = len(pa.chunked_array([c for p in parts for c in p.links["pair"].chunks]).unique())
                if seen > BATCH_PAIRS or links > BATCH_LINKS or docs > BATCH_DOCS:
                    yield _packed((task << 32) + made, parts)
                    made, parts, seen, links, docs = made + 1, [], 0, 0, 0
        if parts:
            yield _packed((task << 32) + made, parts)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _STORED)


def pair_counts(batches: DataFrame) -> DataFrame:
    """Documents per pair of ids over all batches, ``count``, with ``best``: the highest count of its first id."""
    each = batches.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p")).select(F.col("p.pairs").alias("pair"), F.col("p.n_docs").alias("n"))
    counts = keep(each.groupBy("pair").agg(F.sum("n").alias("count")))
    first = F.call_function("div", F.col("pair"), F.lit(SECOND).cast("long"))
    highest = counts.groupBy(first.alias("first")).agg(F.max("count").alias("highest"))
    judged = counts.withColumn("first", first).join(highest, "first")
    return judged.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the documents of each batch from the counts of its pairs."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in batch.schema.names}
            n_pairs = row["n_pairs"].values.to_numpy().astype(np.int64)
            number, times = _unpacked(row["payload"].as_buffer(), int(n_pairs.sum()))
            at, n, top = (row["counts"].values.field(c).to_numpy(zero_copy_only=False) for c in ("at", "count", "best"))
            count, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=bool)
            count[at], best[at] = n, top
            doc = np.repeat(np.arange(len(n_pairs)), n_pairs)
            table = pa.table({"doc": doc, "best": times * best[number], "sum": times * count[number]})
            summed = table.group_by("doc", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
            n_best, count_sum = np.zeros(len(n_pairs), dtype=np.int64), np.zeros(len(n_pairs), dtype=np.int64)
            n_best[summed["doc"].to_numpy()], count_sum[summed["doc"].to_numpy()] = summed["best_sum"].to_numpy(), summed["sum_sum"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [*[row[c].values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")], pa.array(n_best), pa.array(count_sum), row["digests"].values],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def report(documents: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """Per document its tokens of both sides, groups, links, links with the best pair of their first id, and the sum of counts."""
    batches = keep(align_batches(documents, first_path, second_path))
    counted = pair_counts(batches)
    own = batches.select("batch", F.posexplode("pairs").alias("at", "pair"))
    back = own.join(counted, "pair").groupBy("batch").agg(F.collect_list(F.struct("at", "count", "best")).alias("counts"))
    empty = F.array().cast("array<struct<at:int,count:bigint,best:boolean>>")
    both = batches.drop("pairs", "n_docs").join(back, "batch", "left").withColumn("counts", F.coalesce("counts", empty))
    return both.mapInArrow(_sums, _RESULT)
