"""N-gram Jaccard self-join of documents with signature trees.

Two documents link when the Jaccard similarity of their sets of distinct word shingles is
at least ``num / den``.  The join is exact: no link between different texts is lost.

1. *Sets.*  One scan gives every document's set size and a 128-bit sum over its shingles,
   and counts shingles in a table of fixed size.  Equal sets form a class, which the
   smallest doc_id represents; from here on copies cost nothing.
2. *Work units.*  Two sets at the threshold share ``k`` shingles among the first
   ``n - ceil(t n) + k`` of each in any common order (the prefix principle); ``k`` grows with
   the set, and a set with fewer shared ones than its smallest partner's ``k`` is out.  The order puts
   shingles of frequent slots last, so common passages hardly ever enter a prefix.  Sorted
   runs of (shingle, set) are streamed; all sets of a run join the unit named by the run's
   smallest set.  Near copies share nearly all runs, so a set is in few units.
3. *Trees.*  A unit is split into blocks of bounded size by hash (one hub set is part of every
   block).  In each task the sets are leaves of a tree; an inner node holds the OR of its
   leaves' token bitmaps and the ranges of unit and set size.  A dual traversal drops node
   pairs whose size ranges or whose largest possible overlap rule a link out, and those
   that lie in one component already.  Leaf pairs that remain are decided on the sets.
4. *Rest.*  In units of several blocks, the sets outside the unit's largest component meet
   all blocks of the unit; a set inside it can only gain a link to one outside.

Definitions: words are lower-cased (A-Z) runs of ``[^\\x20\\x09-\\x0D]``.  A text with fewer
than ``width`` words has its whole word sequence as one shingle.  Null, empty and blank texts
have the empty set and link with nothing.  Rows that repeat a doc_id each have the component of
their own text; a shared doc_id is no link.  A row without doc_id has no component, or that of
equal texts; it does not link otherwise.  Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .components import components
from .storage import fresh_name, saved
from .textops import SPACED, U64, chunks, mix, shingle_sets, shingles, sized_shingle_sets

SLOT_BITS = 18  # shingle counters: a table of fixed size
BITMAP_WORDS = 32  # 2,048 bits per set or node
FANOUT = 8
BLOCK_SHINGLES = 500_000  # about 4 MB of hashes in a block
TASK_SHINGLES = 1_500_000  # units handled by one traversal
FEW = 200_000  # rows of a few numbers that are broadcast
SHARED_STEP = 50  # one more shared prefix shingle is asked for every so many shingles of a set


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id reachable by links, the document's own included.
    """
    return row_components(docs, id_col, text_col, width, num, den).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def row_components(docs: DataFrame, id_col: str, text_col: str, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, s1, s2, root, component_id) of every row; see ``by_units``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    seen = saved(docs.mapInArrow(_profiler(width), "doc_id long, n long, s1 long, s2 long, slot int, hits long"))
    rows = seen.where("slot IS NULL").select("doc_id", "n", "s1", "s2")
    # a fixed number of rows (2^18) whatever the input: how often shingles of a slot occur
    slots = seen.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("hits").alias("hits")).toPandas()
    level = np.zeros(1 << SLOT_BITS, np.uint8)
    if len(slots):
        hits = slots["hits"].to_numpy(np.float64)
        level[slots["slot"].to_numpy()] = np.clip(np.floor(4 * np.log2(1 + hits / np.median(hits))), 0, 255)
    level = docs.sparkSession.sparkContext.broadcast(level)

    found = (docs.select("text").mapInArrow(_prefixes(width, num, den, level), "token long, n long, s1 long")
             .repartition("token").sortWithinPartitions("token", "n", "s1").mapInArrow(runs(num, den), "leader long, s1 long, times long"))
    smallest = F.ceil(F.col("n") * num / den)  # of a partner
    return by_units(docs, rows, found, width, num, den, 1 + F.floor(smallest / SHARED_STEP))


def by_units(docs: DataFrame, rows: DataFrame, found: DataFrame, width: int, num: int, den: int, least: Column) -> DataFrame:
    """Links decided within work units; see the module's text, steps 2 to 4.

    docs: doc_id, text.  rows: doc_id and its set's size and sums n, s1, s2.  found: leader, s1
    of the sets that belong to a unit, and by how many runs (times).  least: how many runs a
    set of size n must be part of.  Returns doc_id, n, s1, s2, root, component_id.  Sets are told
apart by s1, as one doc_id may stand for several; ``root`` is a component's smallest s1.
    """
    found = saved(found.groupBy("leader", "s1").agg(F.sum("times").alias("times")))
    classes = rows.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class_id"))
    runs_of = found.groupBy("s1").agg(F.sum("times").alias("runs"))
    able = classes.where("class_id IS NOT NULL").join(runs_of, "s1").where(F.col("runs") >= least).select("s1", "class_id", "n")
    units = saved(found.join(able, "s1").select("leader", "class_id", "s1", "n", "times"))
    # kept, so that the join below has two plain shuffles, of which a large unit can be split
    sizes = saved(units.groupBy("leader").agg(
        F.count("*").alias("members"), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).alias("blocks"),
        F.max_by(F.struct("class_id", "s1"), F.struct("times", "class_id", "s1")).alias("hub")).where("members > 1").drop("members"))
    placed = units.join(sizes, "leader").withColumn("block", F.pmod(F.xxhash64("class_id"), "blocks"))
    hubs = sizes.where("blocks > 1").select(
        "leader", "hub.class_id", "hub.s1", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    work = placed.select("leader", "class_id", "s1", "block").union(hubs).distinct()
    joined = _tree_join(docs, work.withColumn("part", F.lit(0)).withColumn("root", F.col("s1")), width, num, den)
    links = saved(joined)
    roots = saved(components(links))

    # units of several blocks: sets outside the largest component against every block
    large = placed.where("blocks > 1").join(roots.withColumnRenamed("node", "s1"), "s1", "left").select(
        "leader", "class_id", "s1", "n", "block", "blocks", F.coalesce("root", "s1").alias("root"))
    core = large.groupBy("leader", "root").agg(F.count("*").alias("c")).groupBy("leader").agg(
        F.max_by("root", F.struct("c", "root")).alias("core"))
    rest = saved(large.join(core, "leader").where("root <> core"))
    if not rest.isEmpty():
        parts = rest.groupBy("leader").agg(F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES)).alias("parts"))
        every = large.join(parts, "leader").select(
            "leader", "class_id", "s1", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "root")
        outer = rest.join(parts, "leader").select(
            "leader", "class_id", "s1", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            F.pmod(F.hash("class_id"), "parts").alias("part"), "root")
        more = _tree_join(docs, every.union(outer).distinct(), width, num, den)
        roots = saved(components(links.union(more)))

    linked = roots.withColumnRenamed("node", "s1")
    names = linked.join(able, "s1").groupBy("root").agg(F.min("class_id").alias("component_id"))
    linked = linked.join(names, "root")
    classes = classes.join(linked, "s1", "left").select(
        "n", "s1", "s2", F.coalesce("root", "s1").alias("root"), F.coalesce("component_id", "class_id").alias("component_id"))
    return rows.join(classes, ["n", "s1", "s2"], "left").select(
        "doc_id", "n", "s1", "s2", "root", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each component: one of each group of near copies.

    It has the component's smallest doc_id (none, if no row has any) and, of several such rows,
    the smallest set.  Blank texts have no component; of those, equal rows of a doc_id are one.
    """
    found = saved(row_components(docs, "doc_id", "text", width, num, den).select("doc_id", "n", "s1", "s2", "root"))
    # rows are known by doc_id and set, as rows of one doc_id may be in several components
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "n", "s1", "s2")
    kept = saved(found.where("n > 0").groupBy("root").agg(F.min(row).alias("row")).select("row.doc_id", "row.n", "row.s1", "row.s2"))
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    out = found.where("n > 0 AND doc_id IS NOT NULL").select("doc_id").join(kept, "doc_id", "left_anti")
    into = fresh_name(docs, "set")
    suspects = saved(out.union(again).distinct().select(F.col("doc_id").alias(f"{into}_id")))  # only their texts are looked at
    of = F.col("doc_id") == F.col(f"{into}_id")
    few = _few(suspects)
    clear = docs.where("doc_id IS NOT NULL").join(few, of, "left_anti")
    unclear = docs.join(few, of, "left_semi").union(docs.where("doc_id IS NULL"))
    # columns go by place from here on: names that hold dots do not reach Python functions
    safe = [c if c in ("doc_id", "text") else f"{into}_column{k}" for k, c in enumerate(docs.columns)]
    unclear = unclear.toDF(*safe)
    schema = StructType([*unclear.schema.fields, *(StructField(f"{into}_{c}", LongType()) for c in ("n", "s1", "s2"))])
    rows = unclear.mapInArrow(_with_set_sums(width, schema.names), schema)
    key = ["doc_id", *(f"{into}_{c}" for c in ("n", "s1", "s2"))]
    names = [f"{into}_kept_{c}" for c in ("id", "n", "s1", "s2")]
    same = [F.col(mine).eqNullSafe(F.col(theirs)) for mine, theirs in zip(key, names)]
    mine = rows.where(f"{into}_n > 0").join(kept.toDF(*names), same, "left_semi").dropDuplicates(key)
    blank = rows.where(f"{into}_n = 0").dropDuplicates(["doc_id", "text"])
    return clear.union(mine.select(safe)).union(blank.select(safe))


def _need(n: int, num: int, den: int) -> int:
    """The smallest overlap that a set of ``n`` has with any partner."""
    return -(-num * n // den)


def set_sums_of(s: np.ndarray) -> tuple[int, int]:
    return int(mix(s, 1).sum().view(np.int64)), int(mix(s, 2).sum().view(np.int64))


def first_sums(w, width: int) -> list[tuple[int, int]]:
    """Per text of a chunk, the size of its set and the first sum over it."""
    return [(len(s), set_sums_of(s)[0] if len(s) else 0) for _, s in shingle_sets(w, width)]


def set_sums(width: int):
    """doc_id, n, s1, s2 of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), *(set_sums_of(s) if len(s) else (0, 0))) for _, w in chunks(batch.column(1), SPACED) for _, s in shingle_sets(w, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (zip(*sets) if sets else ((), (), ())))],
                                             ["doc_id", "n", "s1", "s2"])
    return run


def _with_set_sums(width: int, names: list[str]):
    """Batches with a column ``text``, and its set's n, s1, s2 as last columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), *(set_sums_of(s) if len(s) else (0, 0))) for _, w in chunks(batch.column("text"), SPACED) for _, s in shingle_sets(w, width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.int64()) for c in (zip(*sets) if sets else ((), (), ())))], names)
    return run


def _profiler(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            ns, s1, s2 = [], [], []
            for _, w in chunks(batch.column(1), SPACED):
                for _, s in shingle_sets(w, width):
                    a, b = set_sums_of(s) if len(s) else (0, 0)
                    ns.append(len(s))
                    s1.append(a)
                    s2.append(b)
                h, _ = shingles(w, width)
                hits += np.bincount((h >> U64(64 - SLOT_BITS)).astype(np.int64), minlength=1 << SLOT_BITS)
            none = pa.nulls(len(ns))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 none.cast(pa.int32()), none.cast(pa.int64())], ["doc_id", "n", "s1", "s2", "slot", "hits"])
        used = np.flatnonzero(hits)
        none = pa.nulls(len(used)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(used, pa.int32()), pa.array(hits[used])],
            ["doc_id", "n", "s1", "s2", "slot", "hits"])
    return run


def _prefixes(width: int, num: int, den: int, level):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # sets of this task; copies need no second prefix
        for batch in batches:
            for _, w in chunks(batch.column(0), SPACED):
                tokens, keys, sizes, lens = [], [], [], []
                for _, s, size in sized_shingle_sets(w, width):
                    if not len(s) or (key := set_sums_of(s)[0]) in done:
                        continue
                    done.add(key)
                    p = len(s) - _need(len(s), num, den) + 1 + len(s) // SHARED_STEP
                    often = level.value[(s >> U64(64 - SLOT_BITS)).astype(np.int64)].astype(U64)
                    rank = often << U64(56) | (U64(255) - np.minimum(size, 255).astype(U64)) << U64(48) | mix(s, 3) >> U64(16)
                    tokens.append(s[np.argpartition(rank, p - 1)[:p]] if p < len(s) else s)
                    keys.append(key)
                    sizes.append(len(s))
                    lens.append(min(p, len(s)))
                if tokens:
                    rows = (np.array(c, np.int64).repeat(lens) for c in (sizes, keys))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens).view(np.int64)), *map(pa.array, rows)], ["token", "n", "s1"])
    return run


def runs(num: int, den: int):
    """(first set, set, number of runs) over runs of one token that hold at least two sets.

    Rows come sorted by (token, n, s1).  A run ends where the next set is too large to link
    with the one before it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = n0 = leader = None  # the end of the previous batch, and the leader of its last run
        alone = True  # that leader has not been sent
        for batch in batches:
            t, n, s = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(t):
                continue
            goes_on = token is not None and t[0] == token and den * n0 >= num * n[0]
            starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (den * n[:-1] < num * n[1:])])
            first = s[starts]
            if goes_on:
                first[0] = leader
            of = np.repeat(first, np.diff(np.r_[starts, len(t)]))
            other = s != of
            has = np.add.reduceat(other, starts) > 0
            unsent = np.ones(len(starts), bool)
            if goes_on:
                unsent[0] = alone
            send = first[has & unsent]
            pairs = np.stack((np.r_[send, of[other]], np.r_[send, s[other]]), 1)
            if len(pairs):
                pairs, times = np.unique(pairs, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, (pairs[:, 0], pairs[:, 1], times))), ["leader", "s1", "times"])
            alone = not has[-1] and (alone if goes_on and len(starts) == 1 else True)
            token, n0, leader = t[-1], n[-1], first[-1]
    return run


def _few(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are counted to be at most ``FEW``."""
    return F.broadcast(rows) if rows.limit(FEW + 1).count() <= FEW else rows


def _tree_join(docs: DataFrame, work: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(a, b) links between sets (s1) found in each (leader, block, part); ``root`` is the known component.

    Texts meet their units by doc_id and set, so rows that repeat a doc_id go to the units of their own sets only.
    """
    work = saved(work)
    wanted = work.select(F.col("class_id").alias("wanted")).distinct()
    some = docs.join(_few(wanted), F.col("doc_id") == F.col("wanted"), "left_semi").select("doc_id", "text")
    sets = some.mapInArrow(_texts_of_sets(width), "id long, sum long, text string")
    texts = sets.join(_few(work), (F.col("id") == F.col("class_id")) & (F.col("sum") == F.col("s1")))
    texts = texts.select("leader", "block", "part", "class_id", "s1", "root", "text")
    return (texts.repartition("leader", "block", "part").sortWithinPartitions("leader", "block", "part")
            .mapInArrow(_traverser(width, num, den), "a long, b long"))


def _texts_of_sets(width: int):
    """doc_id, first sum of the set, and text of (doc_id, text); equal ones of a batch once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sums, at, known = batch.column(0).to_pylist(), [], [], set()
            for first, w in chunks(batch.column(1), SPACED):
                for i, s in shingle_sets(w, width):
                    if len(s) and (key := (ids[first + i], set_sums_of(s)[0])) not in known:
                        known.add(key)
                        at.append(first + i)
                        sums.append(key[1])
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(sums, pa.int64()), batch.column(1).take(at)], ["id", "sum", "text"])
    return run


def _traverser(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[tuple, int, int, np.ndarray]] = []
        weight, last, seen = 0, None, set()
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            sums, roots = (batch.column(i).to_pylist() for i in (4, 5))
            for at, w in chunks(batch.column(6), SPACED):
                for i, s in shingle_sets(w, width):
                    key, row = keys[at + i], at + i
                    if key != last:
                        if weight >= TASK_SHINGLES:
                            yield _links(held, num, den)
                            held, weight = [], 0
                        last, seen = key, set()
                    # of rows that repeat a doc_id, one with the set that is meant
                    if sums[row] in seen or not len(s) or set_sums_of(s)[0] != sums[row]:
                        continue
                    seen.add(sums[row])
                    held.append((key, sums[row], roots[row], s))
                    weight += len(s) + BITMAP_WORDS
        if held:
            yield _links(held, num, den)
    return run


def _links(held: list, num: int, den: int) -> pa.RecordBatch:
    names: dict[tuple, int] = {}
    unit = np.array([names.setdefault(h[0], len(names)) for h in held])
    order = np.lexsort((np.array([h[1] for h in held]), np.array([len(h[3]) for h in held]), unit))
    ids = np.array([held[i][1] for i in order])
    _, comp = np.unique(np.array([held[i][2] for i in order]), return_inverse=True)
    found = SignatureTree(unit[order], [held[i][3] for i in order], num, den).links(comp)
    a, b = (ids[[p[k] for p in found]] if found else np.zeros(0, np.int64) for k in (0, 1))
    keep = a != b  # a hub that stands in its own block twice
    return pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], ["a", "b"])


class SignatureTree:
    """A tree over sets that are sorted by (unit, size); see the module's text, step 3."""

    def __init__(self, unit: np.ndarray, sets: list[np.ndarray], num: int, den: int):
        self.sets, self.num, self.den = sets, num, den
        n = np.array([len(s) for s in sets], np.int64)
        bits = np.zeros((len(sets), BITMAP_WORDS), U64)
        for i, s in enumerate(sets):
            at = (s & U64(64 * BITMAP_WORDS - 1)).astype(np.int64)
            np.bitwise_or.at(bits[i], at >> 6, U64(1) << (at & 63).astype(U64))
        # bits that a partner must share: those of the set less the shingles it may lack
        need = np.bitwise_count(bits).sum(1).astype(np.int64) - (n - -(-num * n // den))
        self.levels = [dict(ulo=unit, uhi=unit, nlo=n, nhi=n, bits=bits, need=need)]
        while len(self.levels[-1]["nlo"]) > FANOUT:
            x = self.levels[-1]
            cut = np.arange(0, len(x["nlo"]), FANOUT)
            self.levels.append({
                "ulo": np.minimum.reduceat(x["ulo"], cut), "uhi": np.maximum.reduceat(x["uhi"], cut),
                "nlo": np.minimum.reduceat(x["nlo"], cut), "nhi": np.maximum.reduceat(x["nhi"], cut),
                "bits": np.bitwise_or.reduceat(x["bits"], cut), "need": np.minimum.reduceat(x["need"], cut)})

    def links(self, comp: np.ndarray) -> list[tuple[int, int]]:
        """Links that join all sets which links connect, given components known already."""
        self.comp, self.found = comp.copy(), []
        top = len(self.levels) - 1
        x, y = np.triu_indices(len(self.levels[top]["nlo"]), 0 if top else 1)
        stack = [(top, x, y)]
        self._refresh()
        while stack:
            k, x, y = stack.pop()
            if len(x) > 4096:
                stack += [(k, x[4096:], y[4096:]), (k, x[:4096], y[:4096])]
                continue
            x, y = self._possible(k, x, y)
            if not len(x):
                continue
            if k == 0:
                self._decide(x, y)
                continue
            count, kids = len(self.levels[k - 1]["nlo"]), np.arange(FANOUT)
            cx = np.repeat(x[:, None] * FANOUT + kids, FANOUT, 1).ravel()
            cy = np.tile(y[:, None] * FANOUT + kids, (1, FANOUT)).ravel()
            ok = (cx < count) & (cy < count) & ((cx < cy) if k == 1 else (cx <= cy))
            cx, cy = cx[ok], cy[ok]
            near = cx == cy
            if near.any() and not near.all():
                stack += [(k - 1, cx[~near], cy[~near]), (k - 1, cx[near], cy[near])]
            else:
                stack.append((k - 1, cx, cy))
        return self.found

    def _possible(self, k, x, y):
        t = self.levels[k]
        for ok in (lambda x, y: (t["ulo"][y] <= t["uhi"][x]) & (t["ulo"][x] <= t["uhi"][y]),
                   lambda x, y: (self.den * t["nhi"][x] >= self.num * t["nlo"][y]) & (self.den * t["nhi"][y] >= self.num * t["nlo"][x]),
                   lambda x, y: (self.uniform[k][x] < 0) | (self.uniform[k][x] != self.uniform[k][y]),
                   lambda x, y: self._overlap(t, k, x, y)):
            keep = ok(x, y)
            x, y = x[keep], y[keep]
        return x, y

    def _overlap(self, t, k, x, y):
        out = np.empty(len(x), bool)
        for i in range(0, len(x), 4096):
            a, b = x[i:i + 4096], y[i:i + 4096]
            if k:
                shared = np.bitwise_count(t["bits"][a] & t["bits"][b]).sum(1)
                out[i:i + 4096] = shared >= np.maximum(t["need"][a], t["need"][b])
            else:  # the sets' difference is at least that of their bitmaps
                apart = np.bitwise_count(t["bits"][a] ^ t["bits"][b]).sum(1)
                out[i:i + 4096] = apart * (self.den + self.num) <= (self.den - self.num) * (t["nlo"][a] + t["nlo"][b])
        return out

    def _decide(self, x, y):
        for i in range(0, len(x), 256):
            a, b = x[i:i + 256], y[i:i + 256]
            differ = self.comp[a] != self.comp[b]
            for p, q in zip(a[differ].tolist(), b[differ].tolist()):
                if self.comp[p] != self.comp[q] and self._linked(self.sets[p], self.sets[q]):
                    self.found.append((p, q))
                    self.comp[self.comp == self.comp[q]] = self.comp[p]
        self._refresh()

    def _linked(self, s, t):
        both = np.concatenate((s, t))
        both.sort(kind="stable")
        shared = int(np.count_nonzero(both[1:] == both[:-1]))
        return self.den * shared >= self.num * (len(both) - shared)

    def _refresh(self):
        """The component of every node whose leaves all have the same, else -1."""
        lo = hi = self.comp
        self.uniform = [self.comp]
        for t in self.levels[:-1]:
            cut = np.arange(0, len(t["nlo"]), FANOUT)
            lo, hi = np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut)
            self.uniform.append(np.where(lo == hi, lo, -1))
