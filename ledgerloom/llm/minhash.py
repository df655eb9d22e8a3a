"""MinHash fingerprints of documents, and near-copy classes from banded fingerprints.

A fingerprint keeps, for each of ``PERMUTATIONS`` universal hash permutations
``x -> a x + b (mod 2^32)`` with odd ``a``, the smallest value over the text's five-word
shingles.  The likeness of two fingerprints is their share of equal minima, an unbiased
estimate of the Jaccard similarity of the shingle sets.  All permutations run over whole
batches of shingles in numpy.

``near_copy_classes`` joins bands of minima in Spark and verifies the Jaccard similarity of
the sets themselves, within work units as in the n-gram join.

``fingerprints_and_classes`` is both: the class beside the fingerprints of every row.

Words are lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]``; a text of one to four words has
its whole word sequence as one shingle.  A text without words (null, empty, blank) has the
fingerprint of the empty set, like only to itself.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import ngram_join
from .storage import saved
from .textops import SPACED, U64, chunks, mix, shingles

PERMUTATIONS = 128
WIDTH = 5
ROWS_PER_BAND = 6  # 21 bands: a pair at the threshold of 0.8 shares one with probability 0.998, one at 0.5 with 0.28
BUCKET_ROWS = 4096  # neighbours by doc_id are found in buckets of about so many rows
MOST_BUCKETS = 10_000
SLICE = 512  # texts handled at once
KNOWN_SETS = 100_000  # sets that a task remembers, to send the bands of copies once

_rng = np.random.default_rng(4)
_A = (_rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
EMPTY = np.uint32(0xFFFFFFFF)


def signatures(texts: pa.Array) -> np.ndarray:
    """One row of ``PERMUTATIONS`` minima per text."""
    out = np.full((len(texts), PERMUTATIONS), EMPTY, np.uint32)
    for at, w in chunks(texts, SPACED):
        h, doc = shingles(w, WIDTH)
        if not len(h):
            continue
        x = (h >> U64(32)).astype(np.uint32)
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        rows = at + doc[starts]
        y = np.empty_like(x)
        for k in range(PERMUTATIONS):
            np.multiply(x, _A[k], out=y)
            np.add(y, _B[k], out=y)
            out[rows, k] = np.minimum.reduceat(y, starts)
    return out


def as_text(signature: np.ndarray) -> str:
    """The fingerprint: the low 16 bits of every minimum, in hex."""
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a.astype(np.uint16) == b.astype(np.uint16)))


def edited_fingerprints(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness.

    The edited text has the last ``n_chars // 3`` code points replaced by the first as many
    (or all) of the next document in descending doc_id (null last, repeated ids by text); the
    last document's next is the first.  Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next; an empty table gives an empty one.

    Rows are dealt by doc_id into contiguous buckets (quantiles of the id column alone).  The
    first row of every bucket is also sent to the end of the bucket before it, so each bucket
    is streamed by itself in sorted order, one text ahead; texts are shuffled once.
    """
    return _fingerprints(docs, bucket_rows, None).drop("class_id")


def _fingerprints(docs: DataFrame, bucket_rows: int, classes: DataFrame | None) -> DataFrame:
    """``edited_fingerprints`` with ``class_id``: that of ``classes`` (doc_id, class_id; an id once), else the doc_id.

    Classes go to their ids' buckets as narrow rows, which come before the rows of the id; the wide
    fingerprints need no shuffle to meet them.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    n = ids.count()
    buckets = min(MOST_BUCKETS, max(1, n // bucket_rows))
    share = [i / buckets for i in range(1, buckets)]
    cuts = ids.agg(F.percentile_approx("doc_id", share, 10_000).alias("q")).first()["q"] if share else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket(doc_id: pd.Series) -> pd.Series:
        at = len(cuts) - np.searchsorted(cuts, doc_id.fillna(0).to_numpy(np.int64), "left")
        return pd.Series(np.where(doc_id.isna(), len(cuts), at).astype(np.int32))

    # at most MOST_BUCKETS rows: the largest id of every bucket
    heads = [(r["b"], r["m"]) for r in ids.groupBy(bucket("doc_id").alias("b")).agg(F.max("doc_id").alias("m")).orderBy("b").collect()]
    guests = [(m, heads[i - 1][0]) for i, (_, m) in enumerate(heads)]
    guests = docs.sparkSession.createDataFrame(guests, "head long, before int")
    both = docs.join(F.broadcast(guests), docs["doc_id"].eqNullSafe(guests["head"]), "left")
    rows = both.select(bucket("doc_id").alias("own"), "before", "doc_id", "text")
    rows = rows.select(F.explode(F.filter(F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(0).alias("guest")),
        F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guest"))), lambda x: x["bucket"].isNotNull())).alias("to"), "doc_id", "text")
    rows = rows.select("to.bucket", "to.guest", "doc_id", F.lit(None).cast("long").alias("class_id"), "text")
    if classes is not None:
        rows = rows.union(classes.select(bucket("doc_id"), F.lit(0), "doc_id", "class_id", F.lit(None).cast("string")))
    rows = rows.repartition("bucket")
    rows = rows.sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("class_id").desc_nulls_last(), "text")
    return rows.mapInArrow(_pair_off, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                      "edited_fingerprint string, near_edited double, near_next double, class_id long")


def _pair_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each own row with the row after it in its bucket."""
    held, told = None, (None, None)  # the row that waits for its next, and the class row seen last
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            part, told = _with_classes(batch.slice(at, SLICE), told)
            if not len(part):
                continue
            rows = pa.Table.from_batches([held, part] if held is not None else [part]).combine_chunks()
            held = rows.slice(len(rows) - 1).to_batches()[0]
            own, guest = rows.column("bucket").to_pylist(), rows.column("guest").to_pylist()
            of = rows.column("class_id").to_pylist()
            ids, texts = rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()
            plain = signatures(rows.column("text").combine_chunks())
            todo = [i for i in range(len(rows) - 1) if not guest[i] and own[i] == own[i + 1]]
            edits = []
            for i in todo:
                k = len(texts[i]) // 3
                edits.append(texts[i][:len(texts[i]) - k] + texts[i + 1][:k])
            edited = signatures(pa.array(edits, pa.large_string()))
            out = [(ids[i], len(texts[i]), hashlib.sha256(e.encode()).hexdigest(), as_text(plain[i]), as_text(s),
                    likeness(plain[i], s), likeness(plain[i], plain[i + 1]), of[i]) for i, e, s in zip(todo, edits, edited)]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64())
            cols = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [
                "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id"])


def _with_classes(part: pa.RecordBatch, told: tuple) -> tuple[pa.RecordBatch, tuple]:
    """The rows of texts with their ids' classes, and the class row seen last."""
    at, of = [], []
    for i, (doc, found) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("class_id").to_pylist())):
        if found is not None:
            told = (doc, found)
        else:
            at.append(i)
            of.append(told[1] if doc == told[0] else doc)
    columns = {name: part.column(name).take(pa.array(at, pa.int64())) for name in part.schema.names}
    return pa.RecordBatch.from_pydict(columns | {"class_id": pa.array(of, pa.int64())}), told


def near_copy_classes(docs: DataFrame, num: int = 80, den: int = 100, rows_per_band: int = ROWS_PER_BAND) -> DataFrame:
    """(doc_id, class_id): documents joined by verified links of Jaccard ``num / den`` or more.

    Candidates share all minima of a band; each band value's texts are a work unit, in which
    similarity is decided on the shingle sets.  ``class_id`` is the smallest doc_id of the class.
    A row without doc_id has the class of equal texts, if any; rows that repeat a doc_id each have
    the class of their own text; texts without words link with nothing.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = saved(docs.mapInArrow(ngram_join.set_sums(WIDTH), "doc_id long, n long, s1 long, s2 long"))
    runs = (docs.select("text").mapInArrow(_bands(rows_per_band), "token long, n long, s1 long")
            .repartition("token").sortWithinPartitions("token", "n", "s1").mapInArrow(ngram_join.runs(num, den), "leader long, s1 long, times long"))
    return ngram_join.by_units(docs, rows, runs, WIDTH, num, den, F.lit(1)).select("doc_id", F.col("component_id").alias("class_id"))


def fingerprints_and_classes(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``edited_fingerprints`` with ``class_id``: of documents joined by near copies, the smallest doc_id.

    Rows that repeat a doc_id share the smallest class of their texts; a row without doc_id has none.
    """
    classes = near_copy_classes(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    return _fingerprints(docs, bucket_rows, classes.where("class_id <> doc_id"))


def _bands(rows_per_band: int):
    bands_of = PERMUTATIONS // rows_per_band

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # copies need no second row; forgotten now and then, as it only saves work
        for batch in batches:
            if len(done) > KNOWN_SETS:
                done.clear()
            sig = signatures(batch.column(0))
            keys = [s for _, w in chunks(batch.column(0), SPACED) for s in ngram_join.first_sums(w, WIDTH)]
            fresh = [i for i, (n, k) in enumerate(keys) if n and not (k in done or done.add(k))]
            if not fresh:
                continue
            bands = sig[fresh][:, :bands_of * rows_per_band].reshape(len(fresh), bands_of, rows_per_band).astype(U64)
            token = np.zeros(bands.shape[:2], U64)
            for k in range(rows_per_band):
                token = mix(token * U64(0x9E3779B97F4A7C15) + bands[:, :, k], k + 1)
            token = mix(token + np.arange(bands.shape[1], dtype=U64)[None, :])
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.ravel().view(np.int64)),
                 *(pa.array(np.repeat(c, bands.shape[1])) for c in np.array([keys[i] for i in fresh], np.int64).T)],
                ["token", "n", "s1"])
    return run
