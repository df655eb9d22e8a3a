"""Ranked lexical search by K2-treaps over the term-document grid.

Shards of documents hold their postings of the asked terms as a grid, a row a term and a column a
document.  A quadtree over the grid keeps, level by level, only cells that hold postings: each has
a mask of its four quarters, the place of its first quarter in the next level, and the largest
impact below it.  An item is a trie of the row paths of its terms.  Its paths descend together: a
state is a range of documents with the cells on the paths that are not empty there, and its bound
is the sum of the cells' maxima times the weights of the item's terms beneath them.  States are
opened best first, some at once; a range of one document has its score for a bound.  A shard is
done with an item when the k-th best score beats all bounds left (ranges that tie are opened), so
each shard hands on at most k rows per item, and ranks over those are exact.

Terms are the runs of digits, letters and non-ASCII characters, lower-cased in A-Z alone, and are
told apart by 64-bit hashes.  Weights, impacts and ties are those of :func:`search`.

Items are worked on in groups of at most ``TERMS`` terms, whose hashes every task gets; one group
will do for a benchmark of the usual size.  Postings are written once a group to the shared folder.

Null texts have no terms and null doc_ids rank last; rows of one doc_id rank each for itself, and
so do rows of one item_id with the same text or not.  Empty texts, items or tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .storage import new_folder
from .textops import ALNUM, chunks
from .pieces import cut_long

TERMS = 1 << 20  # terms of a group of items, repeats across items counted
POSTINGS = 1 << 19  # postings of a shard, about
OPENED = 256  # ranges opened at once
NO_ID = np.iinfo(np.int64).max


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the different term hashes of every item, as little-endian bytes."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, np.uint64)] * len(batch)
            for rows, w in _runs(batch.column(1)):
                for k, row in enumerate(rows):
                    found[row] = np.union1d(found[row], w.hash[w.first[k]:w.first[k + 1]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.tobytes() for h in found], pa.binary())], ["item_id", "terms"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(terms, "item_id long, terms binary")


def _runs(texts: pa.Array):
    """(rows, words) of texts in pieces; a very long text's come in several."""
    for rows, part in cut_long(texts, ALNUM):
        for at, w in chunks(part, ALNUM):
            yield rows[at:at + w.n_docs], w


def shards_of(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Postings of ``terms`` (sorted hashes): rows of (docs, words, ids, sizes, doc, term, tf), arrays as bytes.

    ids and sizes (words) are of every document with a term of any kind; doc counts within ids.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, held, size = shared.value, [], 0

        def handed():
            ids, sizes, doc, term, tf = (np.concatenate(c) for c in zip(*held))
            order = np.lexsort((ids, sizes))  # neighbours of like size have like impacts
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order))
            cols = [len(ids), int(sizes.sum()), ids[order], sizes[order], place[doc], term, tf]
            return pa.RecordBatch.from_arrays([pa.array([c if isinstance(c, int) else c.tobytes()]) for c in cols], SHARD_COLUMNS)

        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for at in range(0, len(batch), 512):
                part = batch.column(1).slice(at, 512)
                words, found = np.zeros(len(part), np.int64), []
                for rows, w in _runs(part):
                    words[rows] += w.counts  # a row stands once in a run
                    k = np.searchsorted(terms, w.hash)
                    k[k == len(terms)] = 0
                    hit = terms[k] == w.hash if len(terms) else np.zeros(len(k), bool)
                    keys, n = np.unique(rows[w.doc[hit]] * (len(terms) + 1) + k[hit], return_counts=True)
                    found.append((keys, n))
                keys = np.concatenate([k for k, _ in found]) if found else np.zeros(0, np.int64)
                keys, which = np.unique(keys, return_inverse=True)
                tf = np.bincount(which, np.concatenate([n for _, n in found]) if found else None, len(keys)).astype(np.int64)
                some = np.flatnonzero(words)
                place = np.cumsum(words > 0) - 1 + sum(len(x[0]) for x in held)
                held.append((ids[at + some], words[some], place[keys // (len(terms) + 1)].astype(np.int32),
                             (keys % (len(terms) + 1)).astype(np.int32), tf))
                size += len(keys) + len(some)
                if size >= POSTINGS:
                    yield handed()
                    held, size = [], 0
        if held:
            yield handed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sharded, "docs long, words long, ids binary, sizes binary, doc binary, term binary, tf binary")


SHARD_COLUMNS = ["docs", "words", "ids", "sizes", "doc", "term", "tf"]


def document_counts(shards: DataFrame) -> DataFrame:
    """(term, docs): in how many documents each asked term stands."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                term, n = np.unique(np.frombuffer(raw, np.int32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int64)), pa.array(n.astype(np.int64))], ["term", "docs"])

    return shards.select("term").mapInArrow(counted, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


# ---- the tree ---------------------------------------------------------------------------

def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` at the even places of 64."""
    x = x.astype(np.uint64)
    for s, m in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(s))) & np.uint64(m)
    return x


class K2Treap:
    """Cells of all levels in one array each, the root first; leaves have an empty mask."""

    def __init__(self, row: np.ndarray, col: np.ndarray, impact: np.ndarray, depth: int):
        self.depth = depth
        code = _spread(row) << np.uint64(1) | _spread(col)
        order = np.argsort(code)
        code, top = code[order], impact[order]
        levels = [(np.zeros(len(code), np.uint8), np.zeros(len(code), np.int64), top)]
        for _ in range(depth):
            up = code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
            mask = np.bitwise_or.reduceat(np.left_shift(1, (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8), first)
            top = np.maximum.reduceat(top, first)
            levels.append((mask, first, top))
            code = up[first]
        levels.reverse()
        base = np.cumsum([0] + [len(x[0]) for x in levels])
        self.mask = np.concatenate([m for m, _, _ in levels])
        self.first = np.concatenate([f + base[k + 1] for k, (_, f, _) in enumerate(levels)])
        self.top = np.concatenate([t for _, _, t in levels])


class Paths:
    """The row paths of an item's terms as a trie: per node its two children and the weight beneath."""

    def __init__(self, rows: np.ndarray, weight: np.ndarray, depth: int):
        levels, child = [], None
        for k in range(depth + 1):
            up, which = np.unique(rows >> k, return_inverse=True)
            levels.append((up, np.bincount(which, weight, len(up)).astype(np.int64)))
        levels.reverse()
        base = np.cumsum([0] + [len(x[0]) for x in levels])
        self.child = np.full((base[-1], 2), -1, np.int64)
        for k in range(depth):
            here, below = levels[k][0], levels[k + 1][0]
            self.child[base[k] + np.searchsorted(here, below >> 1), below & 1] = base[k + 1] + np.arange(len(below))
        self.weight = np.concatenate([w for _, w in levels])


_BELOW = np.array([[bin(m & ((1 << q) - 1)).count("1") for q in range(4)] for m in range(16)], np.int64)


def best_columns(tree: K2Treap, paths: Paths, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(columns, scores) of the k best columns and all that tie with the last."""
    cols, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    bound, level, col = tree.top[:1] * paths.weight[0], np.zeros(1, np.int64), np.zeros(1, np.int64)
    start, size = np.zeros(1, np.int64), np.ones(1, np.int64)
    cell, node = np.zeros(1, np.int64), np.zeros(1, np.int64)  # of all states, one after the other
    while len(bound):
        pick = np.argpartition(-bound, OPENED)[:OPENED] if len(bound) > OPENED else np.arange(len(bound))
        rest = np.ones(len(bound), bool)
        rest[pick] = False
        at = np.repeat(start[pick] - np.concatenate(([0], np.cumsum(size[pick])[:-1])), size[pick]) + np.arange(size[pick].sum())
        c, p, s = cell[at], node[at], np.repeat(np.arange(len(pick)), size[pick])
        mask, parts = tree.mask[c], []
        for q in range(4):
            to = paths.child[p, q >> 1]
            ok = (mask >> q & 1 == 1) & (to >= 0)
            parts.append((2 * s[ok] + (q & 1), tree.first[c[ok]] + _BELOW[mask[ok], q], to[ok]))
        s, c, p = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(s, kind="stable")
        s, c, p = s[order], c[order], p[order]
        new = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
        b = np.add.reduceat(tree.top[c] * paths.weight[p], new) if len(s) else np.zeros(0, np.int64)
        which = s[new] >> 1 if len(s) else new
        l, x = level[pick][which] + 1, 2 * col[pick][which] + (s[new] & 1 if len(s) else 0)
        n = np.diff(np.concatenate((new, [len(s)])))
        done = l == tree.depth
        if done.any():
            cols, scores = np.concatenate((cols, x[done])), np.concatenate((scores, b[done]))
        least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else 1
        keep, old = ~done & (b >= least), rest & (bound >= least)
        held = scores >= least
        cols, scores = cols[held], scores[held]
        # the states left, their cells moved together
        take = np.concatenate((start[old], len(cell) + new[keep]))
        cell, node = np.concatenate((cell, c)), np.concatenate((node, p))
        size = np.concatenate((size[old], n[keep]))
        bound, level, col = (np.concatenate(v) for v in ((bound[old], b[keep]), (level[old], l[keep]), (col[old], x[keep])))
        start = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64) if len(size) else np.zeros(0, np.int64)
        at = np.repeat(take - start, size) + np.arange(size.sum())
        cell, node = cell[at], node[at]
    return cols, scores


def _searched(shared, k: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs, n_words, weight, items = shared.value
        for batch in batches:
            for at in range(len(batch)):
                ids, sizes, doc, term, tf = (np.frombuffer(batch.column(c)[at].as_py(), t) for c, t in (
                    ("ids", np.int64), ("sizes", np.int64), ("doc", np.int32), ("term", np.int32), ("tf", np.int64)))
                if not len(doc):
                    continue
                m = 100 - 50 + (50 * sizes * n_docs) // n_words
                impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
                # rows from common terms to rare ones, so that neighbours are alike; told apart from the top levels on
                here = np.unique(term)
                here = here[np.lexsort((here, weight[here]))]
                depth = max(1, int(max(len(here), len(ids)) - 1).bit_length())
                row_of = np.full(len(weight), -1, np.int64)
                row_of[here] = np.arange(len(here)) << depth - int(len(here) - 1).bit_length()
                tree = K2Treap(row_of[term], doc, impact, depth)
                out = []
                for item, (_, terms) in enumerate(items):
                    rows = row_of[terms]
                    some = (rows >= 0) & (weight[terms] > 0)
                    if not some.any():
                        continue
                    cols, scores = best_columns(tree, Paths(rows[some], weight[terms[some]], depth), k)
                    best = np.lexsort((ids[cols], -scores))[:k]
                    out.append((np.full(len(best), item), ids[cols[best]], scores[best]))
                if out:
                    item, doc_id, score = (np.concatenate(c) for c in zip(*out))
                    names = pa.array([i for i, _ in items], pa.int64()).take(pa.array(item))
                    yield pa.RecordBatch.from_arrays([pa.array(item), names, pa.array(doc_id), pa.array(score)], ["item", "item_id", "doc_id", "score"])

    return searched


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of every item (item_id, text).

    A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))) and adds w (10^9 tf div (1000 tf + 20 m)),
    m = 100 - 50 + 50 n N div L, for N documents with a term, L words in all, n of the document's.
    Scores are above 0; ties go to the smaller doc_id.
    """
    spark = docs.sparkSession
    asked = new_folder(spark, "items")
    item_terms(items).withColumn("size", F.length("terms") / 8).write.parquet(asked)
    asked = spark.read.parquet(asked).where(F.col("size") > 0)
    groups = max(1, -(-int(asked.agg(F.sum("size")).first()[0] or 0) // TERMS))
    parts = []
    for g in range(groups):
        some = asked.where(F.pmod(F.xxhash64("terms", "item_id"), F.lit(groups)) == g).select("item_id", "terms").collect()
        some = sorted(((r.item_id, np.frombuffer(r.terms, np.uint64)) for r in some), key=lambda x: (x[0] is None, x[0] or 0, x[1].tobytes()))
        terms = np.unique(np.concatenate([t for _, t in some])) if some else np.zeros(0, np.uint64)
        folder = new_folder(spark, "postings")
        shards_of(docs, terms).write.parquet(folder)
        shards = spark.read.parquet(folder)
        n_docs, n_words = shards.agg(F.sum("docs"), F.sum("words")).first()
        df = np.zeros(len(terms), np.int64)
        for r in document_counts(shards).collect():  # as many rows as the group has terms, at most
            df[r.term] = r.docs
        weight = np.floor(1000 * np.log((2 * (n_docs or 0) + 2) / (2 * df + 1))).astype(np.int64)
        shared = spark.sparkContext.broadcast((n_docs, n_words, weight, [(i, np.searchsorted(terms, t)) for i, t in some]))
        found = shards.mapInArrow(_searched(shared, k), "item long, item_id long, doc_id long, score long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
        parts.append(found.withColumn("rank", rank).where(F.col("rank") <= k).select(
            "item_id", F.col("rank").cast("int"), F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out
