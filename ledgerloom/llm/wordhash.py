"""Words and word n-grams of many texts at once, as arrays of 64-bit hashes.

A word is a run of characters other than the six ASCII blanks. Texts are hashed in joined form, so
that the cost per text is small, and in pieces of bounded size, so that memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PIECE_BYTES = 1 << 20
WORDS_AT_ONCE = 1 << 17
_BASE = 0x9E3779B97F4A7C55
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
# Blanks and ASCII punctuation.
BLANK_OR_MARK = BLANK.copy()
BLANK_OR_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_U = np.uint64


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    values = values ^ (values >> _U(32))
    values = values * _U(0xD6E8FEB86659FD93)
    values ^= values >> _U(32)
    values = values * _U(0xD6E8FEB86659FD93)
    values ^= values >> _U(32)
    return values


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers, the same on every machine."""
    return mixed(np.arange(1, count + 1, dtype=_U) * _U(2 * seed + 1) + _U(_BASE)) | _U(1)


_powers = np.ones(1, dtype=_U)


def _power_table(length: int) -> np.ndarray:
    global _powers
    if len(_powers) < length:
        table = np.full(max(length, 2 * len(_powers)), _BASE, dtype=_U)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, outside: np.ndarray | None = None
) -> np.ndarray:
    """A hash of each span of bytes; spans are in order and what lies between is ``outside``."""
    out = np.empty(len(starts), dtype=_U)
    for low in range(0, len(starts), WORDS_AT_ONCE):
        some = starts[low : low + WORDS_AT_ONCE]
        begin, end = some[0], ends[min(low + WORDS_AT_ONCE, len(ends)) - 1]
        widths = np.diff(np.append(some, end))
        place = np.arange(end - begin) - np.repeat(some - begin, widths)
        values = data[begin:end].astype(_U)
        values += _U(1)
        values *= _power_table(int(widths.max()))[place]
        if outside is not None:
            values[outside[begin:end]] = 0
        out[low : low + WORDS_AT_ONCE] = np.add.reduceat(values, some - begin)
    return mixed(out)


class Words:
    """The words of a list of texts.

    ``hashes`` holds one hash per word, ``starts`` and ``ends`` its bytes in ``data``; the words of
    text i are at ``first[i]`` up to ``first[i + 1]``. A null or blank text has none.
    """

    def __init__(self, texts: Sequence[str | None], fold: bool = True, breaks: np.ndarray = BLANK):
        parts = [(text.lower() if fold else text).encode() if text else b"" for text in texts]
        self.data = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", dtype=np.uint8)
        sizes = np.fromiter((len(part) + 1 for part in parts), dtype=np.int64, count=len(parts))
        self.offsets = np.concatenate(([0], np.cumsum(sizes))) + 1
        blank = breaks[self.data]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = span_hashes(self.data, self.starts, self.ends, blank)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the ``size``-word windows of each text, in order, and where each text begins.

        A text of fewer words has one window that holds them all; a text without words has none.
        """
        counts = self.counts()
        windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        first = np.concatenate(([0], np.cumsum(windows)))
        place = np.arange(first[-1]) - np.repeat(first[:-1] - self.first[:-1], windows)
        padded = np.concatenate((self.hashes, np.zeros(size, dtype=_U)))
        out = np.zeros(len(place), dtype=_U)
        whole = np.repeat(counts >= size, windows)
        left = np.repeat(self.first[1:], windows) - place
        for step, factor in enumerate(multipliers(size, 7)):
            word = padded[place + step] * factor
            out += word if whole.all() else np.where(whole | (step < left), word, _U(0))
        return mixed(out), first

    def span_bytes(self, low: int, high: int) -> bytes:
        """The bytes from word ``low`` up to the end of word ``high - 1``."""
        return self.data[self.starts[low] : self.ends[high - 1]].tobytes()


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` (``PIECE_BYTES``) of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        which = np.cumsum(sizes, dtype=np.int64) // (size or PIECE_BYTES)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(which)) + 1, [batch.num_rows]))
        for low, high in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(low, high - low)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()
