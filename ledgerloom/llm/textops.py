"""Words and word shingles of whole texts as 64-bit hashes, vectorised over Arrow batches.

A batch is handled in chunks of about a megabyte of UTF-8 (at least one text), so the
working arrays stay small whatever the batch size; a single longer text is one chunk.

Word hashes are polynomial prefix sums modulo 2^64 over a fixed random value per byte,
passed through a 64-bit finaliser.  Upper-case A-Z share the values of a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)

_byte = np.arange(256)
#: every byte but \x20 and \x09-\x0D: the class [^\x20\x09-\x0D] on UTF-8
SPACED = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
#: digits, letters a-z and A-Z, and every byte of a non-ASCII character
ALNUM = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x41) & (_byte <= 0x5A)) \
    | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)

_fold = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte)
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64)[_fold]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective finaliser on 64-bit values."""
    x = x + U64(salt)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of an odd base modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.have = base, np.ones(1, U64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.have) < n:
            step = np.full(max(n, 2 * len(self.have)), U64(self.base), U64)
            step[0] = 1
            self.have = np.cumprod(step, dtype=U64)
        return self.have[:n]


_POW, _INV = _Powers(_BASE), _Powers(_BASE_INV)


@dataclass
class Words:
    """The words of a chunk: ``doc`` counts within the chunk; spans are bytes of ``data``."""

    data: np.ndarray
    n_docs: int
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # per text, the index of its first word; one more entry at the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def word_hash(word: str) -> int:
    """The hash that :func:`words` gives to ``word``."""
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0])


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hashes of spans of bytes, as of words."""
    return _hashes(data, start, end)


def _hashes(data, start, end):
    run = np.zeros(len(data) + 1, U64)
    np.cumsum(_VALUE[data] * _POW.upto(len(data)), dtype=U64, out=run[1:])
    return mix((run[end] - run[start]) * _INV.upto(len(data) + 1)[start], 0x51)


def words(data: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> Words:
    """Maximal runs of word bytes; ``ends`` holds where each text ends in ``data``."""
    n = len(data)
    flag = np.zeros(n + 2, bool)
    flag[1:-1] = is_word[data]
    inside = flag[1:-1]
    opens, closes = inside & ~flag[:-2], inside & ~flag[2:]
    cut = ends[(ends > 0) & (ends < n)]  # a word never spans two texts
    opens[cut] = inside[cut]
    closes[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.concatenate(([0], np.searchsorted(start, ends, "left")))
    doc = np.repeat(np.arange(len(ends)), np.diff(first))
    return Words(data, len(ends), doc, start, end, _hashes(data, start, end), first)


def chunks(texts: pa.Array, is_word: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, Words]]:
    """(index of the first text, words) of consecutive runs of texts; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offs, raw = texts.buffers()
    at = np.frombuffer(offs, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield i, words(data[at[i]:at[j]], at[i + 1:j + 1] - at[i], is_word)
        i = j


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, text index) of all ``width``-word shingles in order of position.

    A text of 1 to ``width - 1`` words has one shingle, its whole word sequence.
    """
    return sized_shingles(w, width)[:2]


def sized_shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`shingles`, and the bytes of each shingle's words."""
    h = w.hash
    m = max(0, len(h) - width + 1)
    sums = np.zeros(m, U64)
    for k in range(width):
        sums = sums * U64(_BASE) + h[k:k + m]
    run = np.concatenate(([0], np.cumsum(w.end - w.start)))
    keep = w.doc[:m] == w.doc[width - 1:width - 1 + m] if m else np.zeros(0, bool)
    full, full_doc, full_size = mix(sums[keep], width), w.doc[:m][keep], (run[width:][:m] - run[:m])[keep]
    counts = w.counts
    short = np.flatnonzero((counts > 0) & (counts < width))
    if not len(short):
        return full, full_doc, full_size
    part = np.zeros(len(short), U64)
    for k in range(width - 1):
        has = counts[short] > k
        part[has] = part[has] * U64(_BASE) + h[w.first[short[has]] + k]
    part = mix(mix(part, 0x77) + counts[short].astype(U64), width)
    size = run[w.first[short + 1]] - run[w.first[short]]
    order = np.argsort(np.concatenate((full_doc, short)), kind="stable")
    return tuple(np.concatenate(x)[order] for x in ((full, part), (full_doc, short), (full_size, size)))


def shingle_sets(w: Words, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(text index, sorted distinct shingle hashes) of every text of a chunk."""
    h, doc = shingles(w, width)
    at = np.searchsorted(doc, np.arange(w.n_docs + 1))
    for i in range(w.n_docs):
        yield i, np.unique(h[at[i]:at[i + 1]])


def sized_shingle_sets(w: Words, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As :func:`shingle_sets`, and the bytes of each shingle's words."""
    h, doc, size = sized_shingles(w, width)
    at = np.searchsorted(doc, np.arange(w.n_docs + 1))
    for i in range(w.n_docs):
        s, first = np.unique(h[at[i]:at[i + 1]], return_index=True)
        yield i, s, size[at[i]:at[i + 1]][first]
