"""Words of Arrow text batches as flat arrays: no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken at a time; one longer text is taken alone.
SLICE_BYTES = 4 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class Words(NamedTuple):
    """Flat words of some texts: ``words[offsets[k]:offsets[k + 1]]`` are those of text ``k``."""

    words: pa.Array
    offsets: np.ndarray


def whole_texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large string array, null texts as empty ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.cast(pa.large_string()).fill_null("")


def slices(batch: pa.RecordBatch, text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of consecutive rows with about ``most`` bytes of text each."""
    column = whole_texts(batch.column(text))
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large string array and the place of each text in them."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def split_words(texts: pa.Array) -> Words:
    """Words between blanks (space, tab to carriage return) of a large string array without nulls."""
    data, bounds = text_bytes(texts)
    solid = ~_BLANK[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    # A text that starts with a word starts one, whatever ends the text before it.
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] = solid[first]
    kept = data[solid]
    starts = np.cumsum(solid, dtype=np.int64)[begins] - 1
    ends = np.append(starts, len(kept))
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(kept.tobytes())])
    counted = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
    return Words(words, counted[bounds])


def word_spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, counted from its text's start, and the words' offsets per text."""
    data, bounds = text_bytes(texts)
    solid = ~_BLANK[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    full = bounds[:-1] < bounds[1:]
    begins[bounds[:-1][full]] = solid[bounds[:-1][full]]
    ends[bounds[1:][full] - 1] = solid[bounds[1:][full] - 1]
    counted = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])[bounds]
    origin = np.repeat(bounds[:-1], np.diff(counted))
    return np.flatnonzero(begins) - origin, np.flatnonzero(ends) + 1 - origin, counted
