"""Words and word shingles of whole texts as 64-bit fingerprints, computed per Arrow batch.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``. Its fingerprint is a polynomial
in its bytes, taken from a running sum, so that all words of a batch cost a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: One odd multiplier per place of a word in a shingle, by rule.
PLACES = np.array([(pow(BASE, 2 * i + 3, 1 << 64) | 1) for i in range(64)], dtype=U)
#: Bytes handled at a time; a longer text is handled alone.
CHUNK = 1 << 20

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int, base: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1024)
        out = np.full(size, base, dtype=U)
        out[0] = 1
        have = _powers[name] = np.multiply.accumulate(out)
    return have[:n]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), offsets
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of about CHUNK bytes: first and last text, their bytes and offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """Words of consecutive texts: byte range, fingerprint, and where each text's words begin."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    bounds: np.ndarray


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def range_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of byte ranges: equal bytes give equal values wherever they stand."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=U)
    np.cumsum((data.astype(U) + U(1)) * powers(n, BASE_INVERSE, "down"), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(n + 1, BASE, "up")[start])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, letters: bool = False) -> Words:
    """Words of texts laid end to end. ``lower``: A-Z as a-z. ``letters``: ASCII punctuation parts words too."""
    n = len(data)
    if lower:
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    apart = is_space(data)
    if letters:
        ascii_word = ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | ((data >= 48) & (data <= 57))
        apart = ~(ascii_word | (data >= 128))
    inside = ~apart
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    if n:
        before[0] = True
        before[1:] = apart[:-1]
        before |= edge[:n]
    start = np.flatnonzero(inside & before)
    after = np.empty(n, dtype=bool)
    if n:
        after[-1] = True
        after[:-1] = apart[1:]
        after |= edge[1:]
    end = np.flatnonzero(inside & after) + 1
    return Words(start, end, range_codes(data, start, end), np.searchsorted(start, offsets))


def shingle_codes(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of the ``size`` words from each word on, and whether they lie in one text."""
    n = len(w.code)
    out = np.zeros(n, dtype=U)
    for k in range(size):
        out[: max(n - k, 0)] += w.code[k:] * PLACES[k]
    count = np.diff(w.bounds)
    place = np.arange(n) - np.repeat(w.bounds[:-1], count)
    return mix(out), place + size <= np.repeat(count, count)


def shingle_sets(w: Words, size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingles; a text of fewer words is one shingle, one without words none."""
    codes, whole = shingle_codes(w, size)
    for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True):
        if b - a >= size:
            yield np.unique(codes[a : b - size + 1])
        elif b > a:
            short = (w.code[a:b] * PLACES[: b - a]).sum(dtype=U) + U(b - a)
            yield mix(np.array([short], dtype=U))
        else:
            yield np.empty(0, dtype=U)
