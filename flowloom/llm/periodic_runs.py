"""Maximal periodic runs of words, found by a suffix automaton whose last occurrences are recoloured word by word.

The words of a text are appended one by one.  The states that hold the suffixes of a prefix are the path from its
state to the root of the automaton's link tree; a state's colour is the end of the last occurrence of its strings.
Appending a word accesses that path, as a link-cut tree does: the path falls into segments of one colour each, which
are read and then recoloured to the new end.  A segment of colour ``j`` whose longest string has ``n`` words says that
the last ``n`` words before ``i`` also ended at ``j`` and, being its last occurrence, nowhere in between.  Where
``i - j <= n`` this is a square of period ``i - j``, and the words from ``j - n + 1`` to ``i`` have that period, which
is the smallest one there; the largest such ``i`` ends the run.  All words but the newest are known to the finished
automaton, so its tree is fixed; paths are kept as colour stacks on its heavy paths, which bounds the segments read by
O(n log n) in all as preferred paths do.

Words outside any run cannot change a run.  Each run has at least 12 words and twice its period, so that every word of it lies
in a stretch of six words that occurs again in the text; the automaton is built over the stretches that such repeats cover,
found by hashes of all texts of an Arrow batch at once.  A hash that two stretches share by chance costs time only.

Defined cases: null and empty texts have no words and no runs; a null id counts as one whose text is taken as it is;
rows that repeat are each reported; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.llm.arrow_words import slices, split_words, whole_texts

#: Words a run has at least; a run also has two periods.
LEAST = 12
#: Words of the stretches whose repeats cover every run.
GRAM = LEAST // 2

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
     ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, lengths of the longest strings, and the state of every prefix."""
    link, length, follow, prefix = [-1], [0], [{}], []
    last = 0
    for word in words:
        here = len(link)
        link.append(0)
        length.append(length[last] + 1)
        follow.append({})
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = here
            at = link[at]
        if at >= 0:
            to = follow[at][word]
            if length[to] == length[at] + 1:
                link[here] = to
            else:
                copy = len(link)
                link.append(link[to])
                length.append(length[at] + 1)
                follow.append(follow[to].copy())
                while at >= 0 and follow[at].get(word) == to:
                    follow[at][word] = copy
                    at = link[at]
                link[to] = link[here] = copy
        prefix.append(here)
        last = here
    return link, length, prefix


def _heavy_paths(link: list[int], length: list[int]) -> list[int]:
    """For each state the top of the heavy path it lies on."""
    order = np.argsort(np.array(length), kind="stable").tolist()
    size = [1] * len(link)
    heavy, largest = [-1] * len(link), [0] * len(link)
    for v in reversed(order[1:]):
        up = link[v]
        size[up] += size[v]
        if size[v] > largest[up]:
            largest[up], heavy[up] = size[v], v
    top = [0] * len(link)
    for v in order[1:]:
        up = link[v]
        top[v] = top[up] if heavy[up] == v and up else v
    return top


def find_runs(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every maximal run of at least ``least`` words and two periods."""
    link, length, prefix = _automaton(words)
    top = _heavy_paths(link, length)
    stacks: list[list[tuple[int, int]]] = [[] for _ in link]
    ends: dict[tuple[int, int], int] = {}
    for i, at in enumerate(prefix):
        known = -1
        while at:
            # The path's part on one heavy path, as (length of the deepest string, colour) from the root downwards.
            head, reach = top[at], length[at]
            stack = stacks[head]
            first = known
            while stack:
                n, colour = stack[-1]
                if n <= reach:
                    stack.pop()
                else:
                    n = reach
                if first == known:
                    first = colour
                # A colour goes on towards the root; its deepest string was read on the path below.
                if colour != known and i - colour <= n:
                    ends[colour - n + 1, i - colour] = i
                if n == reach:
                    break
            known = first
            stack.append((reach, i))
            at = link[head]
    return sorted((s, e - s + 1, p) for (s, p), e in ends.items() if e - s + 1 >= max(least, 2 * p))


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers, one per value."""
    x = values.astype(np.uint64) * _ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def repeated_stretches(ids: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """``(text, first, end)`` of the stretches covered by runs of ``GRAM`` words that occur again in their text."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return []
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key, mixed = _mixed(text[:n] + 1), _mixed(ids.astype(np.int64) + 1)
    for k in range(GRAM):
        key = key * np.uint64(0x100000001B3) + mixed[k : k + n]
    places = np.flatnonzero(text[:n] == text[GRAM - 1 :])
    key = key[places]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(ids) + 1, dtype=np.int32)
    at = places[again]
    covered[at] += 1
    covered[at + GRAM] -= 1
    inside = np.concatenate([[False], np.cumsum(covered[:-1]) > 0, [False]])
    # A stretch ends with its text.
    edges = np.flatnonzero(inside[1:-1] & (~inside[:-2] | np.concatenate([[True], text[1:] != text[:-1]])))
    closes = np.flatnonzero(inside[1:-1] & (~inside[2:] | np.concatenate([text[1:] != text[:-1], [True]]))) + 1
    return [(int(text[a]), int(a), int(b)) for a, b in zip(edges, closes, strict=True) if b - a >= LEAST]


def made_periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words that a text with periodic words has, null where it stays as it is."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def _digest(parts: Iterator[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _report(ids: list[int | None], texts: pa.Array, periodic: bool) -> pa.RecordBatch:
    words, offsets = split_words(texts)
    counts = np.diff(offsets)
    if periodic:
        changed = [(k, made_periodic(i, int(n))) for k, (i, n) in enumerate(zip(ids, counts, strict=True))]
        changed = [(k, at) for k, at in changed if at is not None]
        if changed:
            places = np.arange(len(words))
            for k, at in changed:
                places[offsets[k] : offsets[k + 1]] = offsets[k] + at
            words = words.take(pa.array(places))
    numbers = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, dtype=np.int32)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in ids]
    for k, first, end in repeated_stretches(numbers, offsets):
        shift = first - int(offsets[k])
        runs[k] += [(s + shift, n, p) for s, n, p in find_runs(numbers[first:end].tolist())]
    kept, lengths = np.ones(len(words), dtype=bool), counts.copy()
    for k, found in enumerate(runs):
        if found:
            found.sort(key=lambda r: (r[0], r[2]))
            mine = kept[offsets[k] : offsets[k + 1]]
            for s, n, p in found:
                mine[s + p : s + n] = False
            lengths[k] = mine.sum()
    if not kept.all():
        words = words.filter(pa.array(kept))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words), " ")
    best = [min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None) for found in runs]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array([len(r) for r in runs], pa.int64()),
            *[pa.array([b[c] for b in best], pa.int64()) for c in range(3)],
            pa.array([None if b[2] is None else 1000 * b[1] // b[2] for b in best], pa.int64()),
            pa.array([_digest(f"{s},{n},{p}\n" for s, n, p in found) for found in runs]),
            pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in collapsed]),
        ],
        schema=SCHEMA,
    )


def report(documents: DataFrame, periodic: bool = False) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of all runs and of the text without their repeats.

    With ``periodic`` the words of every tenth document are first repeated periodically, chosen and shaped by the
    checksum of its id.  Words after the first period of a run are left out of the collapsed text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _report(part.column("doc_id").to_pylist(), whole_texts(part.column("text")), periodic)

    fields = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, fields)
