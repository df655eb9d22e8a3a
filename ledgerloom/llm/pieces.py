"""Very long texts in pieces that end between words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PIECE = 1 << 21  # bytes


def cut_long(texts: pa.Array, is_word: np.ndarray, size: int = PIECE) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(rows, texts): all texts of at most ``size`` bytes at once, then the pieces of each longer one, in order.

    A piece ends after ``size`` bytes and what is left of the word there.  Null counts as empty.
    """
    lengths = pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    short = np.flatnonzero(lengths <= size)
    if len(short):
        yield short, texts if len(short) == len(texts) else texts.take(pa.array(short))
    for row in np.flatnonzero(lengths > size).tolist():
        raw = np.frombuffer(texts[row].as_buffer(), np.uint8)
        at = 0
        while at < len(raw):
            end = _end(raw, min(at + size, len(raw)), is_word)
            yield np.array([row]), pa.array([raw[at:end].tobytes()], pa.large_binary()).cast(pa.large_string())
            at = end


def _end(raw: np.ndarray, at: int, is_word: np.ndarray) -> int:
    while at < len(raw):
        part = np.flatnonzero(~is_word[raw[at:at + 4096]])
        if len(part):
            return at + int(part[0])
        at = min(at + 4096, len(raw))
    return at
