"""Words of whole Arrow columns as spans of bytes, found in NumPy without making a string per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are worked on at a time; a longer text is worked on by itself
SLICE_BYTES = 2_000_000

_EACH = np.arange(256, dtype=np.uint8)
#: the byte that each byte becomes when A to Z are lower-cased
LOWER = np.where((_EACH >= 65) & (_EACH <= 90), _EACH + 32, _EACH).astype(np.uint8)
#: bytes of words that end at space, tab, line feed, vertical tab, form feed or return
NOT_BLANK = (_EACH != 32) & ((_EACH < 9) | (_EACH > 13))
#: bytes of words of digits, lower-case letters and everything beyond ASCII
ALNUM = (_EACH >= 128) | ((_EACH >= 48) & (_EACH <= 57)) | ((_EACH >= 97) & (_EACH <= 122))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values one after the other, offset of each value and of the end); a null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    held = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most `most` bytes, one row at least."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of bytes that `inside` marks; runs never cross rows."""
    held = inside[data]
    before = np.empty(len(held) + 1, bool)
    before[0], before[1:] = False, held
    after = np.empty(len(held) + 1, bool)
    after[-1], after[:-1] = False, held
    # a row's first byte has nothing before it, its last byte nothing after it
    before[offsets[:-1]] = False
    after[offsets[1:]] = False
    starts = np.flatnonzero(held & ~before[:-1])
    ends = np.flatnonzero(held & ~after[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one little-endian number; `data` must end in seven spare bytes."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
