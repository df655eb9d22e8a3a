"""Best-fit packing of documents into training sequences of several permitted lengths.

A document is its words plus one end mark; a longer one than the largest permitted length is
cut into full sequences and a rest, so no word is lost.  Each piece carries its part of the
text: from its first word to the next piece's, so a document's pieces in order are its whole
text, blanks included.  ``sequences`` joins the pieces of each bin with the places where
documents begin.  Pieces are dealt to shards by hash.
Within a shard they come in descending size, and each goes to the open bin with the least
room that holds it.  If none does, a bin opens at the permitted length that costs least for
the pieces still to come: for each length, the remaining histogram of sizes is tried on it
(largest piece that fits, again and again), and the least cost per filled token wins.  A
sequence of length L costs ``L + L * L / quadratic + fixed``: linear layers, attention and
the sequence itself.  In the end every bin is downsized to the smallest permitted length
that holds its contents.

Shards have about ``shard_rows`` documents whatever the input, and a shard that many rows of
one doc_id swell, or very long words, is packed in several goes of at most ``MOST_BYTES`` and one batch, so
memory is bounded and a shard wastes at most its last few bins.  Texts are shuffled once.

A document without words (null, empty or blank text) gets one row with null bin and its text.
Rows that repeat a doc_id are packed like others.  An empty table gives an empty one.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .mixing import n_words

LENGTHS = (512, 1024, 2048, 4096)
SHARD_ROWS = 1024
MOST_BYTES = 64 << 20  # of text that a task holds before it packs
WORD = re.compile(r"[^\x20\x09-\x0D]+")
OUT = "doc_id long, piece long, n_tokens long, text string, bin_id long, bin_offset long, bin_capacity long"


def cost(length: int, quadratic: int = 16384, fixed: int = 64) -> float:
    return length + length * length / quadratic + fixed


def pack(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, n_tokens, text, bin_id, bin_offset, bin_capacity."""
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    size = n_words(F.col("text"))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(size > 0, size + 1).otherwise(F.lit(0)).alias("size"))
    shards = max(1, -(-docs.count() // shard_rows))
    # only texts of several pieces go through Python to be cut
    cut = F.arrow_udf("array<string>")(_cutter(top))(F.when(F.col("size") > top, F.col("text")))
    parts = F.when(F.col("size") > top, cut).otherwise(F.array("text"))
    pieces = sized.select("doc_id", "size", F.posexplode(parts).alias("piece", "text")).select(
        "doc_id", F.col("piece").cast("long").alias("piece"), F.least(F.lit(top), F.col("size") - F.col("piece") * top).cast("long").alias("n_tokens"), "text")
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    return (dealt.repartition("shard").sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece")
            .select("shard", "doc_id", "piece", "n_tokens", "text").mapInArrow(_packer(lengths, 8 * shard_rows), OUT))


def sequences(packed: DataFrame) -> DataFrame:
    """One row per bin of ``pack``'s rows: bin_id, bin_capacity, n_tokens, and ``parts``, its
    pieces in order as (bin_offset, doc_id, piece, n_tokens, text).

    A bin holds at most its capacity in pieces.  Documents without words are in none.
    """
    part = F.struct("bin_offset", "doc_id", "piece", "n_tokens", "text")
    return packed.where(F.col("bin_id").isNotNull()).groupBy("bin_id").agg(
        F.max("bin_capacity").alias("bin_capacity"), F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(part)).alias("parts"))


def _cutter(top: int):
    """Texts cut before each word that begins a sequence; the end mark may stand in a piece of its own."""
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts.to_pylist():
                if text is None:
                    out.append(None)
                    continue
                n, at = 0, [0]
                for word in WORD.finditer(text):
                    if n and n % top == 0:
                        at.append(word.start())
                    n += 1
                if n % top == 0:
                    at.append(len(text))
                out.append([text[a:b] for a, b in zip(at, [*at[1:], len(text)])])
            yield pa.array(out, pa.list_(pa.string()))

    cut.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return cut


def _packer(lengths: tuple[int, ...], most_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, rows, weight, bins = None, [], 0, 0, 0
        for batch in batches:
            at = batch.column(0).to_numpy()
            cut = np.flatnonzero(np.diff(at)) + 1
            for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(at)]):
                for start in range(lo, hi, most_rows):
                    part = batch.slice(start, min(hi, start + most_rows) - start)
                    if held and (at[lo] != shard or rows + len(part) > most_rows or weight > MOST_BYTES):
                        packed, opened = _packed(shard, bins, held, lengths)
                        yield packed
                        held, rows, weight, bins = [], 0, 0, bins + opened
                    if at[lo] != shard:
                        shard, bins = int(at[lo]), 0
                    held.append(part)
                    rows += len(part)
                    weight += part.column("text").nbytes
        if held:
            yield _packed(shard, bins, held, lengths)[0]
    return run


def _packed(shard: int, bins_before: int, held: list[pa.RecordBatch], lengths: tuple[int, ...]) -> tuple[pa.RecordBatch, int]:
    """The rows with their bins, and the number of bins; rows without words come last and have none."""
    t = pa.Table.from_batches(held).combine_chunks()
    sizes = t.column("n_tokens").to_numpy()
    none = sizes == 0
    bins, offsets, caps = (np.r_[x, np.zeros(none.sum(), np.int64)] for x in best_fit(sizes[~none], lengths))
    opened = int(bins.max()) + 1 if not none.all() else 0
    col = lambda name: t.column(name).combine_chunks()
    new = (pa.array(x, mask=none) for x in ((np.int64(shard) << 32) + bins_before + bins, offsets, caps))
    return pa.RecordBatch.from_arrays([col("doc_id"), col("piece"), col("n_tokens"), col("text"), *new],
                                      ["doc_id", "piece", "n_tokens", "text", "bin_id", "bin_offset", "bin_capacity"]), opened


def best_fit(sizes: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, capacity) of pieces that come in descending size."""
    left = np.bincount(sizes, minlength=lengths[-1] + 1)
    kinds = sorted(set(sizes.tolist()))
    rooms: list[tuple[int, int]] = []  # (room, bin) of open bins, ascending
    fill: list[int] = []
    which, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    start: list[int] = []
    for i, size in enumerate(sizes.tolist()):
        at = bisect.bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            b, room = len(fill), _least_cost(size, left, kinds, lengths)
            fill.append(0)
            start.append(room)
        which[i], offset[i] = b, fill[b]
        fill[b] += size
        if room > size:
            bisect.insort(rooms, (room - size, b))
        left[size] -= 1
        while kinds and not left[kinds[-1]]:
            kinds.pop()
    fitted = np.array(lengths)[np.searchsorted(lengths, np.array(fill, np.int64))] if fill else np.zeros(0, np.int64)
    return which, offset, fitted[which].astype(np.int64)


def _least_cost(size: int, left: np.ndarray, kinds: list[int], lengths: tuple[int, ...]) -> int:
    best, chosen = None, lengths[-1]
    for length in lengths:
        if length < size:
            continue
        room, used = length - size, {size: 1}
        hi = len(kinds)
        while room and (hi := bisect.bisect_right(kinds, room, 0, hi)):
            kind = kinds[hi - 1]
            n = min(room // kind, int(left[kind]) - used.get(kind, 0))
            if n > 0:
                room -= n * kind
            hi -= 1
        rate = cost(length) / (length - room)
        if best is None or rate < best:
            best, chosen = rate, length
    return chosen
