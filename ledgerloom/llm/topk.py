"""Exact top-k search by distributed histogram selection.

Queries and candidates are dealt into blocks by hash, and every (query block, candidate
block) pair scores all its pairs with one matrix product.  Each round histograms the scores
of every query in ``BINS`` bins over the query's present interval; the summed histograms
locate the bin that holds its k-th value, which is the next interval.  When the interval is
a single score (or its bin completes k exactly), all candidates at or above it are kept, and
ties at the k-th value go to the smaller id.  A block sends at most its own k best per query
in the end, so very many equal scores stay bounded.

A block reports its histogram from the top down to its own k-th value only: the global k-th
value cannot lie below.  Scores are recomputed each round; nothing of size queries x
candidates is kept.  Query and candidate blocks are shuffled, none is broadcast.

Components are floored after scaling: ``floor(64 * x)`` of x as double.  A vector takes no
part if its id is null, or if it is null or holds a null component or one that is not finite
after scaling.  Rows that repeat an id are queries and candidates of their own.  Scores are
exact: blocks of large components are multiplied modulo 2^64, and pairs whose score may not fit
into long are worked out in whole numbers; a score that does not fit is an error.  Only vectors
of equal dimension meet.  A query with fewer than k candidates returns them all.  An empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .storage import saved

BINS = 1024
QUERY_BLOCK = CANDIDATE_BLOCK = 8192  # rows
BLOCK_VALUES = 1 << 19  # components: a block of long vectors has fewer rows


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with ``id % every = 0`` its k best others."""
    scaled = lambda x: x.cast("double") * float(scale)
    sound = ~F.exists(vec_col, lambda x: x.isNull() | F.isnan(scaled(x)) | (F.abs(scaled(x)) == float("inf")))
    # doubles from 2^53 on are whole
    v = F.transform(vec_col, lambda x: F.when(F.abs(scaled(x)) < float(1 << 53), F.floor(scaled(x)).cast("double")).otherwise(scaled(x)))
    clean = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(sound).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    clean = saved(clean.select(F.monotonically_increasing_id().alias("row"), "id", F.size("v").alias("dim"), "v"))
    peak = F.array_max(F.transform("v", lambda x: F.abs(x)))
    n, n_queries, dim, bound = clean.agg(F.count("*"), F.count_if(F.col("id") % every == 0), F.max("dim"), F.max(
        F.size("v") * F.coalesce(peak * peak, F.lit(0.0)))).first()
    of = lambda rows: min(rows, max(64, BLOCK_VALUES // max(1, dim or 0)))
    q_blocks, c_blocks = -(-n_queries // of(QUERY_BLOCK)) or 1, -(-n // of(CANDIDATE_BLOCK)) or 1
    bits = min(63, int(min(bound or 0, 2.0 ** 63)).bit_length() + 1)  # all scores lie in [-2^bits, 2^bits)
    unit = max(0, bits - 60)  # where they are wider, the intervals are of scores shifted by this
    bits = max(1, bits - unit)
    blocks = clean.select("row", "id", "dim", "v", F.pmod(F.xxhash64("row"), F.lit(q_blocks)).alias("qb"),
                          F.pmod(F.xxhash64("row", F.lit(1)), F.lit(c_blocks)).alias("cb"))
    queries = blocks.where(F.col("id") % every == 0)
    # low: the interval's lower end; shift: bits of a bin; above: scores known to lie above the interval
    per_round = BINS.bit_length() - 1
    shift = max(0, -(-(bits + 1 - per_round) // per_round)) * per_round  # so every round has BINS whole bins
    state = queries.select("row", F.lit(-(1 << bits)).cast("long").alias("low"), F.lit(shift).alias("shift"),
                           F.lit(0).cast("long").alias("above"), F.lit(False).alias("found"))
    while True:
        seen = _scan(blocks, queries.join(state.where("NOT found"), "row"), q_blocks, c_blocks, _histogram(k, unit), "row long, bin long, hits long")
        state = saved(_refined(state, seen.groupBy("row", "bin").agg(F.sum("hits").alias("hits")), k))
        if state.where("NOT found").isEmpty():
            break
    kept = _scan(blocks, queries.join(state, "row"), q_blocks, c_blocks, _best(k, unit), "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _refined(state: DataFrame, hist: DataFrame, k: int) -> DataFrame:
    """Narrow every open interval to the bin of the k-th value; a query of fewer than k
    candidates is found with the lowest score of all."""
    down = Window.partitionBy("row").orderBy(F.desc("bin"))
    rows = hist.join(state.where("NOT found"), "row").withColumn("upto", F.col("above") + F.sum("hits").over(down))
    hit = rows.where(F.col("upto") >= k).groupBy("row").agg(F.min_by(F.struct("bin", "hits", "upto"), "upto").alias("h"))
    s = state.join(hit, "row", "left")
    low = F.col("low") + F.col("h.bin") * F.pow(F.lit(2.0), F.col("shift")).cast("long")
    least = F.lit(-(1 << 63)).cast("long")
    done = F.col("found") | F.col("h").isNull() | (F.col("shift") == 0) | (F.col("h.upto") == k)
    return s.select(
        "row", F.when(F.col("found"), F.col("low")).when(F.col("h").isNull(), least).otherwise(low).alias("low"),
        F.greatest(F.lit(0), F.col("shift") - (BINS.bit_length() - 1)).alias("shift"),
        F.coalesce(F.col("h.upto") - F.col("h.hits"), F.col("above")).alias("above"), done.alias("found"))


def _scan(blocks: DataFrame, queries: DataFrame, q_blocks: int, c_blocks: int, fold, schema: str) -> DataFrame:
    """``fold`` over all (query block, candidate block) pairs; a pair's queries come first."""
    none = F.lit(None)
    q = queries.select("dim", "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))).alias("cb"),
                       F.lit(0).alias("side"), "row", "id", "v", "low", "shift")
    c = blocks.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))).alias("qb"), "cb",
                      F.lit(1).alias("side"), "row", "id", "v", none.cast("long").alias("low"), none.cast("int").alias("shift"))
    return (q.union(c).repartition("dim", "qb", "cb").sortWithinPartitions("dim", "qb", "cb", "side", "row")
            .mapInArrow(_by_pair(fold), schema))


def _by_pair(fold):
    """Calls ``fold`` with the queries and the candidates of each pair of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns[:3]], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                if hi == lo:
                    continue
                if held and tuple(keys[lo]) != key:
                    yield from _folded(fold, held)
                    held = []
                key = tuple(keys[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from _folded(fold, held)
    return run


def _folded(fold, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(held).combine_chunks()
    side, rows, ids = (t.column(c).to_numpy() for c in ("side", "row", "id"))
    v = t.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), t.column("dim")[0].as_py())
    nq = int((side == 0).sum())
    if 0 < nq < len(ids):
        low, shift = (t.column(c).slice(0, nq).to_numpy() for c in ("low", "shift"))
        yield from fold((rows[:nq], ids[:nq], v[:nq]), low, shift, (rows[nq:], ids[nq:], v[nq:]))


def _scores(q: np.ndarray, c: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floats where they hold every partial sum.

    own: pairs that are no candidates, whose scores may be anything.
    """
    a, b = (float(np.abs(x).max(initial=0)) for x in (q, c))
    most = max(a, b, q.shape[1] * a * b)
    if most < 1 << 62:
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
        return (q.astype(kind) @ c.astype(kind).T).astype(np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        near, size = np.abs(q @ c.T), np.abs(q) @ np.abs(c).T
        sure = near + size * ((q.shape[1] + 4) * 2.0 ** -52) < 2.0 ** 63
    scores = (_wrapped(q) @ _wrapped(c).T).view(np.int64)  # right modulo 2^64, so right where they fit
    whole = {}
    for i, j in np.argwhere(~sure & ~own).tolist():
        for x, at in ((q, (0, i)), (c, (1, j))):
            if at not in whole:
                whole[at] = [int(y) for y in x[at[1]]]
        if not -(1 << 63) <= sum(map(int.__mul__, whole[0, i], whole[1, j])) < 1 << 63:
            raise OverflowError("the inner product of two vectors does not fit into long")
    return scores


def _wrapped(x: np.ndarray) -> np.ndarray:
    """Whole numbers held by doubles, modulo 2^64."""
    rest = np.abs(np.fmod(x, 2.0 ** 64)).astype(np.uint64)
    return np.where(x < 0, np.uint64(0) - rest, rest)


def _parts(ids: np.ndarray, size: int = 512):
    for at in range(0, len(ids), size):
        yield slice(at, at + size)


def _histogram(k: int, unit: int):
    def fold(queries, low, shift, candidates):
        (rows, _, q), (others, _, c) = queries, candidates
        for part in _parts(rows):
            own = rows[part, None] == others[None, :]
            s = _scores(q[part], c, own) >> unit
            n = len(s)
            at = (s - low[part, None]) >> shift[part, None]
            at[(at < 0) | (at >= BINS) | own] = BINS  # outside, or the query's own row
            at += np.arange(n)[:, None] * (BINS + 1)
            hits = np.bincount(at.ravel(), minlength=n * (BINS + 1)).reshape(n, -1)[:, :BINS]
            better = np.cumsum(hits[:, ::-1], 1)[:, ::-1] - hits
            row, bin_ = np.nonzero((hits > 0) & (better < k))
            yield pa.RecordBatch.from_arrays([pa.array(rows[part][row]), pa.array(bin_), pa.array(hits[row, bin_])], ["row", "bin", "hits"])
    return fold


def _best(k: int, unit: int):
    def fold(queries, low, shift, candidates):
        rows, ids, q = queries
        order = np.argsort(candidates[1], kind="stable")  # so that equal scores come in the order of ids
        others, cand, c = (x[order] for x in candidates)
        for part in _parts(rows):
            own = rows[part, None] == others[None, :]
            s = _scores(q[part], c, own)
            row, col = np.nonzero((s >> unit >= low[part, None]) & ~own)
            score = s[row, col]
            o = np.lexsort((col, ~score, row))
            row, col, score = row[o], col[o], score[o]
            first = np.r_[0, np.flatnonzero(np.diff(row)) + 1]
            place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)])) if len(row) else row
            keep = place < k
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[part][row[keep]]), pa.array(ids[part][row[keep]]), pa.array(cand[col[keep]]), pa.array(score[keep])],
                ["row", "query_id", "vec_id", "score"])
    return fold
