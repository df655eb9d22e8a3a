"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

Words are counted over whole texts.  A word's vector holds how often each of its letters stands
in it; one replaced letter moves it by one up and one down, one inserted letter by one up.  So
the words near a word lie in a small box around its vector among the words of its own length and
of the length beside it.

Each length has a tree over a bounded sample of its words (``SAMPLE`` in all), whose leaves are
the cells that the words are dealt to; a word is asked for in every cell whose box is within
reach.  Words that no count tells apart (anagrams) may overfill a cell; it is dealt in blocks by
hash then, and asked in all of them; so are words asked of a cell, if they are many.  In a cell a k-d tree of its own prunes by boxes, and the
letters of what is left are compared in order.  Per asked word only the number of near words and
the best one leave a cell, never the pairs.

A form is the near word of largest count (ties: the smallest by code points), if that is at least
``ratio`` times the word's own.  Counts grow along forms, so following them ends.

Null texts hold no words; a null doc_id reads as ``null`` in the text that the checksum is taken
of.  Repeated rows count again; other columns are not read; an empty table gives an empty one.
Very long texts are read in pieces between runs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import saved

#: runs of [a-zÀ-ÿ] in lower-cased UTF-8, and what cannot stand within one
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
OUTSIDE = re.compile(rb"[\x00-\x60\x7b-\x7f\xc2\xc4-\xff]")
PIECE = 1 << 20  # bytes of a text read at once
HELD = 200_000  # different words counted in a task before they are handed on
SAMPLE = 200_000  # words that the trees over the cells are built from
CELL = 32_768  # words of a cell, about
LEAF = 48  # words of a leaf within a cell
PAIRS = 1 << 18  # words compared at once

LETTERS = 26 + 64
_DIM = np.full(256, 255, np.uint8)
_DIM[97:123] = np.arange(26)
_DIM[0xC0:] = 26 + np.arange(64)
#: one number a letter, its upper seven bits the letter: a difference of two sums names the letter added
_TAG = (np.arange(1, LETTERS + 1, dtype=np.uint64) << np.uint64(57)) | np.random.default_rng(13).integers(1, 1 << 57, LETTERS, dtype=np.uint64)
_TAGS = np.zeros(128, np.uint64)
_TAGS[1:LETTERS + 1] = _TAG


def pieces(raw: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``raw``, lower-cased UTF-8, cut where no run stands."""
    at = 0
    while at < len(raw):
        cut = OUTSIDE.search(raw, at + size)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end


def without(run: bytes, h: int) -> bytes:
    """``run`` without its code point h % length."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, min_length: int, min_count: int, drop_every: int | None) -> DataFrame:
    """(word, n): the words of all texts; of every ``drop_every``-th a letter is missing."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(total):
            words = [(w, n) for w, n in ((w.decode(), n) for w, n in total.items() if len(w) >= min_length) if len(w) >= min_length]
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())], ["word", "n"])

        total: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, len(batch), 128):
                part = batch.slice(at, 128)
                for doc, raw in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    seed = crc32(f"{'null' if doc is None else doc}:".encode())
                    for piece in pieces(raw.lower()) if raw is not None else ():
                        for run, n in Counter(RUN.findall(piece)).items():
                            if drop_every and (h := crc32(run, seed)) % drop_every == 0:
                                run = without(run, h)
                            total[run] = total.get(run, 0) + n
                        if len(total) > HELD:
                            yield handed(total)
                            total = {}
        yield handed(total)

    found = docs.select(F.col("doc_id").cast("string"), F.col("text")).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- trees -----------------------------------------------------------------------------

def vectors(words: list[bytes]) -> np.ndarray:
    """Letter counts of Latin-1 words, at most 255 each: a bound that distances only shrink by."""
    size = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), LETTERS), np.uint8)
    dims = _DIM[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(size)))
    for at in range(0, len(words), 4096):
        to = min(at + 4096, len(words))
        owner = np.repeat(np.arange(to - at), size[at:to])
        flat = np.bincount(owner * LETTERS + dims[ends[at]:ends[to]], minlength=(to - at) * LETTERS)
        out[at:to] = np.minimum(flat, 255).reshape(-1, LETTERS)
    return out


@dataclass
class Tree:
    """Nodes in arrays: inner ones split ``dim`` at ``cut`` within [lo, hi]; leaves have dim -1."""

    dim: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    lo: list[int] = field(default_factory=list)
    hi: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)  # the left child follows its parent; of a leaf: its number
    held: list[np.ndarray] = field(default_factory=list)  # rows of every leaf

    @classmethod
    def over(cls, v: np.ndarray, capacity: float) -> Tree:
        tree = cls()
        tree._add(v, np.arange(len(v)), capacity, {})
        return tree

    def _add(self, v, rows, capacity, box) -> None:
        k = len(self.dim)
        split = _split(v[rows]) if len(rows) > capacity else None
        dim, cut = split or (-1, 0)
        lo, hi = box.get(dim, (0, 255))
        for a, x in ((self.dim, dim), (self.cut, cut), (self.lo, lo), (self.hi, hi), (self.right, len(self.held))):
            a.append(x)
        if split is None:
            self.held.append(rows)
            return
        low = v[rows, dim] <= cut
        self._add(v, rows[low], capacity, {**box, dim: (lo, cut)})
        self.right[k] = len(self.dim)
        self._add(v, rows[~low], capacity, {**box, dim: (cut + 1, hi)})

    def reach(self, v: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf number, rows of ``v``) where a leaf's box is at most ``up`` above and ``down`` below a row."""
        todo = [(0, np.arange(len(v)), np.zeros(len(v), np.int16), np.zeros(len(v), np.int16))]
        while todo:
            k, rows, above, below = todo.pop()
            if not len(rows):
                continue
            if self.dim[k] < 0:
                yield self.right[k], rows
                continue
            x, cut = v[rows, self.dim[k]].astype(np.int16), self.cut[k]
            less = below - np.maximum(x - self.hi[k], 0) + np.maximum(x - cut, 0)
            more = above - np.maximum(self.lo[k] - x, 0) + np.maximum(cut + 1 - x, 0)
            a, b = less <= down, more <= up
            todo.append((k + 1, rows[a], above[a], less[a]))
            todo.append((self.right[k], rows[b], more[b], below[b]))


def _split(v: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that part rows most evenly; None if all are alike."""
    shares = [(np.abs((v <= c).mean(0) - 0.5), c) for c in range(3)]
    best = min(((s.argmin(), c, s.min()) for s, c in shares), key=lambda x: x[2])
    if best[2] < 0.5:
        return int(best[0]), best[1]
    width = v.max(0).astype(int) - v.min(0)
    d = int(width.argmax())
    return (d, int(v[:, d].min()) + int(width[d]) // 2) if width[d] else None


# ---- cells -----------------------------------------------------------------------------

@dataclass
class Cells:
    """The cells of one length: a tree, and per leaf the blocks of held and of asked words."""

    tree: Tree
    held: np.ndarray
    asked: np.ndarray


def _asked_cells(cells: dict[int, Cells], length: int, v: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(kind, length, leaf, rows) that words of a length and their letter counts go to."""
    for kind, into, up, down in ((0, length, 0, 0), (1, length, 1, 1), (2, length + 1, 1, 0)):
        for leaf, rows in (cells[into].tree if into in cells else _ONE).reach(v, up, down):
            yield kind, into, leaf, rows


_ONE = Tree.over(np.zeros((0, LETTERS), np.uint8), 0)


def cells_of(words: DataFrame, total: int) -> dict[int, Cells]:
    """The cells of every length, from a sample of the words; none if one cell a length will do."""
    if total <= CELL:
        return {}
    share = min(1.0, SAMPLE / total)
    draw = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = words.where(draw).select("word").limit(2 * SAMPLE).toArrow().column(0).to_pylist()
    by_length: dict[int, list[bytes]] = {}
    for w in sorted(sample):
        by_length.setdefault(len(w), []).append(w.encode("latin-1"))
    v = {length: vectors(some) for length, some in by_length.items()}
    cells = {}
    for length in {n + k for n in v for k in (0, 1)}:
        tree = Tree.over(v[length], CELL * share) if length in v else _ONE
        cells[length] = Cells(tree, *np.zeros((2, len(tree.held)), np.int64))
    for length in v:
        for kind, into, leaf, rows in _asked_cells(cells, length, v[length]):
            (cells[into].asked if kind else cells[into].held)[leaf] += len(rows)
    for c in cells.values():  # leaves hold half a cell to a cell unless their words are alike
        c.held = 1 + (c.held // (2 * CELL * share)).astype(np.int64)
        c.asked = 1 + (c.asked // (16 * CELL * share)).astype(np.int64)
    return cells


def _dealt(cells: dict[int, Cells]):
    """Words to the cells that hold them (kind 0) and that are asked for their own (1) and the next length (2)."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            raw = np.array([w.encode("latin-1") for w in words], object)
            size, spread = np.array([len(w) for w in raw], np.int64), np.array([crc32(w) for w in raw], np.int64)
            for length in np.unique(size).tolist():
                here = np.flatnonzero(size == length)
                for kind, into, leaf, rows in _asked_cells(cells, length, vectors(raw[here].tolist())):
                    held, asked = (int(cells[into].held[leaf]), int(cells[into].asked[leaf])) if into in cells else (1, 1)
                    rows = here[rows]
                    if kind:  # one block of the asked, against each of the held
                        copies = np.repeat(rows, held)
                        block = (spread[rows] // 977 % asked)[:, None] * held + np.arange(held)
                    else:
                        copies = np.repeat(rows, asked)
                        block = (spread[rows] % held)[:, None] + held * np.arange(asked)
                    m = len(copies)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, into)), pa.array(np.full(m, leaf)), pa.array(block.ravel()), pa.array(np.full(m, kind)),
                         pa.array(words[copies], pa.string()), pa.array(counts[copies], pa.int64())],
                        ["length", "leaf", "block", "kind", "word", "n"])

    return dealt


def _codes(words: list[bytes], length: int) -> np.ndarray:
    """Words of one length as rows of 64-bit numbers, eight letters each."""
    wide = -(-length // 8) * 8
    return np.frombuffer(b"".join(w.ljust(wide, b"\0") for w in words), np.uint64).reshape(len(words), -1)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where words of equal length differ in exactly one letter."""
    differ = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        x = a[:, None, k] ^ b[None, :, k]
        for s in (4, 2, 1):
            x |= x >> np.uint64(s)
        x &= np.uint64(0x0101010101010101)
        differ += np.bitwise_count(x)
    return differ == 1


def _inserted(a: list[bytes], b: list[bytes], tag_a: np.ndarray, tag_b: np.ndarray) -> np.ndarray:
    """Where the longer word is the shorter one with one letter more."""
    more = tag_b[None, :] - tag_a[:, None]
    hit = _TAGS[more >> np.uint64(57)] == more
    for i, j in zip(*np.nonzero(hit)):
        x, y = a[i], b[j]
        k = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
        hit[i, j] = x[k:] == y[k + 1:]
    return hit


def near_in_cell(held: list[bytes], held_n: np.ndarray, asked: list[bytes], asked_n: np.ndarray, same: bool):
    """Near words among ``held`` of each of ``asked``, and the other way round: counts and the best one's place.

    same: all are of one length; else the held words are one letter longer.
    """
    order = lambda words, n: np.argsort(np.lexsort((np.array(words, object), -n)))
    none = 1 << 60
    rank_held, rank_asked = order(held, held_n), order(asked, asked_n)
    near, best = np.zeros(len(asked), np.int64), np.full(len(asked), none)
    near_held, best_held = np.zeros(len(held), np.int64), np.full(len(held), none)
    v_held, v_asked = vectors(held), vectors(asked)
    if same:
        code_held, code_asked = _codes(held, len(held[0])), _codes(asked, len(held[0]))
    else:
        tag = lambda v, words: v.astype(np.uint64) @ _TAG if max(map(len, words)) < 256 else np.array([_TAG[_DIM[np.frombuffer(w, np.uint8)]].sum(dtype=np.uint64) for w in words])
        tag_held, tag_asked = tag(v_held, held), tag(v_asked, asked)
    tree = Tree.over(v_held, LEAF)
    for leaf, rows in tree.reach(v_asked, 1, 1 if same else 0):
        points = tree.held[leaf]
        step = max(1, PAIRS // len(points))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            if same:
                hit = _replaced(code_asked[part], code_held[points])
            else:
                hit = _inserted([asked[i] for i in part], [held[j] for j in points], tag_asked[part], tag_held[points])
            some = np.flatnonzero(hit.any(1))
            if not len(some):
                continue
            hit, part = hit[some], part[some]
            near[part] += hit.sum(1)
            best[part] = np.minimum(best[part], np.where(hit, rank_held[points], none).min(1))
            if not same:
                near_held[points] += hit.sum(0)
                best_held[points] = np.minimum(best_held[points], np.where(hit, rank_asked[part][:, None], none).min(0))
    back_held, back_asked = np.argsort(rank_held), np.argsort(rank_asked)
    out = [(np.flatnonzero(near), near, back_held[best[near > 0]])]
    if not same:
        out.append((np.flatnonzero(near_held), near_held, back_asked[best_held[near_held > 0]]))
    return out


def _searched(cell: pa.Table) -> pa.Table:
    """(word, near, best_n, best) of the words of one cell's block."""
    kind = cell.column("kind").to_numpy()
    words = np.array([w.encode("latin-1") for w in cell.column("word").to_pylist()], object)
    n = cell.column("n").to_numpy()
    found = []
    held = np.flatnonzero(kind == 0)
    for k in (1, 2):
        asked = np.flatnonzero(kind == k)
        if not len(held) or not len(asked):
            continue
        sides = near_in_cell(words[held].tolist(), n[held], words[asked].tolist(), n[asked], k == 1)
        for (who, near, best), mine, other in zip(sides, (asked, held), (held, asked)):
            found.append((words[mine[who]], near[who], n[other[best]], words[other[best]]))
    cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, object)] * 4
    text = lambda c: pa.array([w.decode("latin-1") for w in c], pa.string())
    return pa.Table.from_arrays([text(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), text(cols[3])],
                                ["word", "near", "best_n", "best"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words of ``words`` (word, n) that have near ones."""
    dealt = _dealt(cells_of(words, words.count()))
    cells = words.select("word", "n").mapInArrow(dealt, "length long, leaf long, block long, kind long, word string, n long")
    found = cells.groupBy("length", "leaf", "block").applyInArrow(_searched, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.minus")).alias("best_n"), "b.best")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word that the forms of ``forms`` (word, form) lead to.

    Paths double in each round; a count at least doubles along a form, so they are few.
    """
    step = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = saved(step.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        step = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            return step


def variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2, drop_every: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs`` (doc_id, text)."""
    words = saved(word_counts(docs, min_length, min_count, drop_every))
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    table = saved(near.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                              F.when(is_form, F.col("best_n")).alias("form_n")))
    last = roots(table.where(F.col("form").isNotNull()))
    return table.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
