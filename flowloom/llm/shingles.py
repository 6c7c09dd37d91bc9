"""Hashes of word shingles, computed for whole batches of texts on their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are hashed in groups of about this many bytes, so that work arrays stay small; a longer text is a group of its own.
GROUP_BYTES = 1 << 21

_RNG = np.random.default_rng(20240607)
#: Random odd multipliers and byte values of the rolling hash; any fixed random values serve.
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_BASE = U64(int(_RNG.integers(1, 2**62)) * 2 + 1)
_UNBASE = U64(pow(int(_BASE), -1, 2**64))
_PLACE = _RNG.integers(1, 2**62, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = _BYTE[_LOWER]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts ``data[offsets[i]:offsets[i + 1]]`` and the first word of each text."""
    n = len(data)
    blank = _BLANK[data]
    before, after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = True
    after[inner - 1] = True
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    powers = np.full(n, _BASE, dtype=U64)
    back = np.full(n, _UNBASE, dtype=U64)
    if n:
        powers[0] = back[0] = 1
    np.multiply.accumulate(powers, out=powers)
    np.multiply.accumulate(back, out=back)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(_VALUE[data] * powers, out=sums[1:])
    words = (sums[ends] - sums[starts]) * back[starts] if n else np.zeros(0, dtype=U64)
    words = mixed(words + (ends - starts).astype(U64) * _PLACE[63])
    return words, np.searchsorted(starts, offsets)


def text_groups(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of consecutive texts; null counts as empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text the hashes of its runs of ``size`` words in order; a shorter text has one, an empty one none."""
    runs = max(0, len(words) - size + 1)
    total = np.zeros(runs, dtype=U64)
    for k in range(size):
        total += words[k : k + runs] * _PLACE[k]
    total = mixed(total)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(total[a : b - size + 1])
        elif b > a:
            out.append(mixed((words[a:b] * _PLACE[: b - a]).sum(keepdims=True) + U64(b - a) * _PLACE[62]))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out
