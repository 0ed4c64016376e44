"""Words of whole Arrow columns of text, found on the bytes, without a Python string for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD, GAP, BREAK = 0, 1, 2
SLICE_BYTES = 4_000_000

#: Capital A-Z to small letters, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """WORD, GAP or BREAK for each of the 256 bytes; bytes of longer UTF-8 characters belong to words."""
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[list(gaps)] = GAP
    kinds[list(breaks)] = BREAK
    return kinds


def text_slices(batches, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``most`` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = text_buffers(batch.column(column))[1]
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offset of each text in them and the end); null texts are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


class Words:
    """The words of some texts: their distinct bytes, a code for each occurrence, and where they stand."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, kinds: np.ndarray):
        kind = kinds[raw]
        inside = kind == WORD
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        before[bounds[:-1][bounds[:-1] < len(raw)]] = False
        #: First byte of each word.
        self.starts = np.flatnonzero(inside & ~before)
        place = np.cumsum(inside, dtype=np.int64)
        letters = raw[inside]
        offsets = np.append(place[self.starts] - 1, len(letters))
        #: Bytes of each word.
        self.lengths = np.diff(offsets)
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)]
        )
        coded = spelled.dictionary_encode()
        self.codes = np.asarray(coded.indices.to_numpy(zero_copy_only=False), dtype=np.int64)
        self.distinct: list[bytes] = coded.dictionary.to_pylist()
        #: First word of each text, and the end.
        self.of_text = np.searchsorted(self.starts, bounds)
        self._kind = kind

    def __len__(self) -> int:
        return len(self.starts)

    def texts(self) -> np.ndarray:
        """The number of the text that each word stands in."""
        return np.repeat(np.arange(len(self.of_text) - 1), np.diff(self.of_text))

    def pieces(self) -> np.ndarray:
        """A number for each word that changes where a BREAK or the end of a text lies between two words."""
        return np.cumsum(self._kind == BREAK, dtype=np.int64)[self.starts] + self.texts()
