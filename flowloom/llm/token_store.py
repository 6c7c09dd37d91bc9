"""Token ids in binary chunks of shuffled bit planes.

Documents are put in id order and encoded; an end id closes each one.  A chunk holds whole documents;
its ids are cut into fixed-size blocks, each block is transposed into bit planes and each plane is
compressed with zstandard.  One row per chunk is written: its place in the index (part, number, first
id within the part, counts, compressed plane sizes), its documents and the payload, so index columns
can be read without payloads, and every chunk can be decoded alone.

Defined cases: null texts are empty and have the end id only; null ids come first; rows that repeat an
id are ordered by text; a document longer than a chunk is a chunk of several blocks; an empty table
gives an empty store.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowloom.functions.sized import keep, scratch_path

#: Ids per block; a plane of a whole block is an eighth of this in bytes.
BLOCK_IDS = 1 << 16
#: Ids after which a chunk is closed at the next end of a document.
CHUNK_IDS = 1 << 18

SCHEMA = (
    "part long, chunk long, part_offset long, n_ids long, n_planes int, doc_ids array<bigint>, lengths array<bigint>,"
    " plane_sizes array<int>, payload binary"
)


def to_planes(ids: np.ndarray, n_planes: int) -> list[bytes]:
    """Bit plane ``k`` of all ids, for each ``k``; bits beyond the last id are zero."""
    bits = (ids[None, :] >> np.arange(n_planes, dtype=np.uint32)[:, None]) & 1
    return [row.tobytes() for row in np.packbits(bits.astype(np.uint8), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n_ids: int) -> np.ndarray:
    out = np.zeros(n_ids, dtype=np.uint32)
    for k, plane in enumerate(planes):
        bits = np.unpackbits(np.frombuffer(plane, dtype=np.uint8), count=n_ids, bitorder="little")
        out |= bits.astype(np.uint32) << np.uint32(k)
    return out


def pack(ids: np.ndarray, level: int = 3) -> tuple[int, list[int], bytes]:
    """Number of planes, compressed sizes (block by block, plane by plane) and payload."""
    press = zstandard.ZstdCompressor(level=level)
    n_planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    pieces = [press.compress(p) for at in range(0, len(ids), BLOCK_IDS) for p in to_planes(ids[at : at + BLOCK_IDS], n_planes)]
    return n_planes, [len(p) for p in pieces], b"".join(pieces)


def unpack(n_ids: int, n_planes: int, sizes: list[int], payload: bytes) -> np.ndarray:
    press, at, out = zstandard.ZstdDecompressor(), 0, []
    view = memoryview(payload)
    pieces = []
    for size in sizes:
        pieces.append(press.decompress(view[at : at + size], max_output_size=BLOCK_IDS // 8 + 64))
        at += size
    for b, first in enumerate(range(0, n_ids, BLOCK_IDS)):
        out.append(from_planes(pieces[b * n_planes : (b + 1) * n_planes], min(BLOCK_IDS, n_ids - first)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint32)


class Known(dict):
    """Values by text, each made when it is first asked for; emptied when it holds more than ``limit``."""

    def __init__(self, make: Callable[[str], bytes], limit: int) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, text: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        found = self[text] = self.make(text)
        return found


class Encoder:
    """Ids of whole texts; each distinct word is handed to the tokenizer once.

    The vocabulary's pre-tokenizer never joins across white space, so a text's ids are those of its
    stretches between spaces, tabs and line ends.  Stretches of ASCII and Latin letters, which no
    normalisation changes but lower case, go to the tokenizer's model piece by piece, others through its
    whole chain.  ``tests/llm`` compares this with encoding whole texts.
    """

    LATIN = "ß-öø-įı-ſ"
    PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ſ]*")
    PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^\sa-z0-9{LATIN}]+")
    GAP = re.compile(r"[ \t\r\n]+")
    #: The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for 256 and on.
    VISIBLE = (*range(33, 127), *range(161, 173), *range(174, 256))
    BYTES = {**{b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - {*range(33, 127), *range(161, 173), *range(174, 256)}))}, **{b: chr(b) for b in VISIBLE}}

    def __init__(self, tokenizer_file: str, cached: int = 400_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.model, self.pieces, self.words = self.tokenizer.model, Known(self._piece, cached), Known(self._word, cached)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else "".join(map(self.BYTES.__getitem__, piece.encode()))
        return self._bytes([t.id for t in self.model.tokenize(text)])

    def _word(self, word: str) -> bytes:
        plain = word.isascii()
        if plain and word.isalpha():
            return self.pieces[word.lower()]
        if (word.isprintable() if plain else self.PLAIN.fullmatch(word)) and not ("<" in word and any(s in word for s in self.special)):
            pieces = self.PIECE.findall(word.lower())
            return b"".join(map(self.pieces.__getitem__, pieces))
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, text: str) -> np.ndarray:
        # Python also splits at four control characters that are no white space to the vocabulary.
        words = self.GAP.split(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype="<u4")


@functools.cache
def encoder_of(tokenizer_file: str) -> Encoder:
    """One encoder per Python worker, whose cache serves all tasks that run there."""
    return Encoder(tokenizer_file)


def _chunks(encoder: Encoder, batches: Iterator[pa.RecordBatch], part: int, end_id: int) -> Iterator[dict]:
    ids, doc_ids, lengths, chunk, offset, held = [], [], [], 0, 0, 0

    def close() -> dict:
        whole = np.concatenate(ids)
        n_planes, sizes, payload = pack(whole)
        return {
            "part": part, "chunk": chunk, "part_offset": offset, "n_ids": len(whole), "n_planes": n_planes, "doc_ids": list(doc_ids),
            "lengths": list(lengths), "plane_sizes": sizes, "payload": payload,
        }

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            row = np.append(encoder.encode(text.as_py() or ""), np.uint32(end_id))
            ids.append(row)
            doc_ids.append(doc_id)
            lengths.append(len(row))
            held += len(row)
            if held >= CHUNK_IDS:
                yield close()
                chunk, offset, held = chunk + 1, offset + held, 0
                ids, doc_ids, lengths = [], [], []
    if doc_ids:
        yield close()


def write_store(documents: DataFrame, path: str, tokenizer_file: str, end_id: int) -> None:
    """Encode every whole text and write chunks in ascending id order, one part per range of ids."""
    types = pa.schema(
        [("part", pa.int64()), ("chunk", pa.int64()), ("part_offset", pa.int64()), ("n_ids", pa.int64()), ("n_planes", pa.int32()),
         ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("plane_sizes", pa.list_(pa.int32())), ("payload", pa.binary())]
    )

    def run(batches):
        from pyspark import TaskContext

        for row in _chunks(encoder_of(tokenizer_file), batches, TaskContext.get().partitionId(), end_id):
            yield pa.RecordBatch.from_pylist([row], schema=types)

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SCHEMA).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index alone, with the id at which each chunk starts in the whole store.

    Parts are summed in order; there is one short row per part, not per document.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path).select("part", "chunk", "part_offset", "n_ids")
    sums = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("part_start"))
    return chunks.join(starts, "part").select("part", "chunk", (F.col("part_start") + F.col("part_offset")).alias("start"), "n_ids", "part_start")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the stored chunks: ``doc_id, start, n_tokens, ids_crc32``."""
    names = ["part", "doc_id", "in_part", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = unpack(row["n_ids"], row["n_planes"], row["plane_sizes"], row["payload"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                columns = [pa.array(np.full(len(ends), row["part"])), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["part_offset"]), pa.array(row["lengths"], pa.int64()), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    stored = spark.read.schema(SCHEMA).parquet(path)
    decoded = stored.mapInArrow(run, "part long, doc_id long, in_part long, n_tokens long, ids_crc32 long")
    part_starts = keep(read_index(spark, path).select("part", "part_start").distinct())
    return decoded.join(part_starts, "part").select("doc_id", (F.col("part_start") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32")


def store_and_read(documents: DataFrame, tokenizer_file: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write the store (to ``path``, or a new folder in shared storage) and report what it holds."""
    spark = documents.sparkSession
    path = path or scratch_path(spark)
    write_store(documents, path, tokenizer_file, end_id)
    return read_documents(spark, path)
