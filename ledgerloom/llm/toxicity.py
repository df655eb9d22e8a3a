"""Toxicity by a convolutional text classifier, trained in numpy.

Each word has two hashed embeddings and its beginning (``STEM`` bytes) two more, side by side: a
word that meets a telling one in one table does not meet it in the other.  Filters of one to three words slide over the whole text;
each filter's maximum feeds a logistic output.  Words are runs of digits, letters and non-ASCII
characters, lower-cased in A-Z alone.

Labels are learned from all labelled documents whose ``crc32(doc_id) mod 4`` is not 2, and from every word of
their texts. Spark deals the documents into shards of about ``SHARD``; in a round each shard trains a
copy of the model, and the changes are averaged by the documents behind them (of an embedding: over the copies
that have met it).  Few shards train several copies each, in other orders, so that there are ``COPIES`` at least:
their mean errs less than one.  One shard makes one round, several make ``ROUNDS``.
A task holds some ``CHUNK`` words at a time.  Words of very few of the documents are not learned from.

A fifth of the documents, by a hash of the doc_id, is kept from training to calibrate by: each language with at least
``LANG_TOXIC`` toxic documents in it gets the threshold of the best F1 (on a grid of 1/``GRID`` of a logit), the
others 0.3.  The score itself depends on the text alone.

Texts that are null or have no word get a score as any text without a telling word.  If nothing is labelled,
or all is alike, every score is the share of toxic labels (0 without any).  Of several labels of one
doc_id the largest counts; null labels and doc_ids are not learned from, and a null doc_id is not
held out.  Repeated rows are judged alike; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .pieces import cut_long
from .storage import fresh_name, new_folder
from .textops import ALNUM, Words, chunks, span_hashes

BUCKETS = 1 << 15
TABLES = 4  # of words, words, stems and stems
PART = 4  # numbers of an embedding
STEM = 6
WIDTHS = (1, 2, 3)
FILTERS = 10  # of each width
SHARD = 8192  # documents that train one copy of the model, about
ROUNDS = 2  # of training, if there are several shards
CHUNK = 1 << 22  # words that a task trains on at a time
BROADCAST = 1 << 20  # labelled doc_ids, at most, that reach the texts by a broadcast
SLICES = 64  # parts of a model that are averaged apart
KEPT = 0.2  # share of the documents that thresholds are set by
GRID = 1024  # steps of a unit of the logit, for thresholds
BATCH = 32
DROPPED = 0.4  # share of words left out at each visit
VISITS = 40_000  # texts seen by a copy in a round, about; each at least twice
COPIES = 4
LANG_TOXIC = 20
THRESHOLD = 0.3
BLOCK = 1 << 16  # word positions worked on at once
PAD = np.uint64(sum(BUCKETS << 16 * k for k in range(TABLES)))  # of rows of zeros


def word_ids(texts: pa.Array) -> list[np.ndarray]:
    """Per text, its words as ``TABLES`` bucket numbers in one 64-bit number each."""
    out: list[list[np.ndarray]] = [[] for _ in range(len(texts))]
    for rows, part in cut_long(texts, ALNUM):
        for at, w in chunks(part, ALNUM):
            ids = _buckets(w)
            for k in range(w.n_docs):
                out[rows[at + k]].append(ids[w.first[k]:w.first[k + 1]])
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def _buckets(w: Words) -> np.ndarray:
    stems = span_hashes(w.data, w.start, np.minimum(w.end, w.start + STEM))
    low = np.uint64(BUCKETS - 1)
    parts = [h >> np.uint64(s) & low for h in (w.hash, stems) for s in (0, 20)]
    return sum(p << np.uint64(16 * k) for k, p in enumerate(parts))


def _table(ids: np.ndarray, k: int) -> np.ndarray:
    """Bucket numbers in table ``k``."""
    return (ids >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.int64)


_STEMS = ~np.uint64(0) << np.uint64(32)


def _stream(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts one after the other, pads after each, and where each begins.

    The window at the first pad holds pads alone; those at the others belong to no text.
    """
    pad = np.full(max(WIDTHS), PAD)
    size = np.array([len(t) + len(pad) for t in texts], np.int64)
    return np.concatenate([x for t in texts for x in (t, pad)]), np.cumsum(size) - size


class ConvNet:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.base = None  # the score of every text if there is nothing to tell apart
        self.by_lang = {}
        self.mask = np.zeros((max(WIDTHS), 1, n), np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[:width, :, k * FILTERS:(k + 1) * FILTERS] = 1
        self.embed = (rng.standard_normal((TABLES, BUCKETS + 1, PART)) * 0.1).astype(np.float32)
        self.embed[:, BUCKETS] = 0
        self.p = {"conv": (rng.standard_normal((max(WIDTHS), TABLES * PART, n)) * 0.3).astype(np.float32) * self.mask, "bias": np.full(n, 0.1, np.float32),
                  "out": (rng.standard_normal(n) * 0.6).astype(np.float32), "out_bias": np.full(1, -1, np.float32)}

    def settle(self) -> None:
        """Round the weights to few enough bits that responses are exact in any order of adding up:
        equal texts get equal scores, whatever stands beside them."""
        grid = lambda x, bits, most=np.inf: np.clip(np.round(x * (1 << bits)) / (1 << bits), -most, most)
        self.embed = grid(self.embed, 6, 4).astype(np.float32)
        self.p["conv"] = grid(self.p["conv"], 8, 4).astype(np.float32)
        self.p |= {k: grid(self.p[k].astype(float), 14) for k in ("bias", "out", "out_bias")}

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return np.concatenate([self.embed[k][_table(ids, k)] for k in range(TABLES)], 1)

    def responses(self, ids: np.ndarray) -> np.ndarray:
        """Of all filters at every position but the last ones, whose windows ``ids`` does not hold."""
        e, t = self.vectors(ids), len(ids) - max(WIDTHS) + 1
        z = e[:t] @ self.p["conv"][0]
        for k in range(1, max(WIDTHS)):  # filters of k words end before this tap
            z[:, k * FILTERS:] += e[k:k + t] @ self.p["conv"][k][:, k * FILTERS:]
        return z

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """Per text, every filter's maximum over all positions, in blocks of positions."""
        out = np.full((len(texts), self.p["bias"].size), -np.inf, np.float32)
        ids, begin = _stream(texts)
        n = len(ids)
        ids, outside = np.concatenate((ids, ids[n - max(WIDTHS) + 1:])), np.zeros(n, bool)
        for k in range(1, max(WIDTHS)):
            outside[np.append(begin[1:], n) - k] = True
        for at in range(0, n, BLOCK):
            to = min(at + BLOCK, n)
            z = self.responses(ids[at:to + max(WIDTHS) - 1])
            z[outside[at:to]] = -np.inf
            first, last = np.searchsorted(begin, [at, to - 1], "right") - 1
            cuts = np.maximum(begin[first:last + 1] - at, 0)
            out[first:last + 1] = np.maximum(out[first:last + 1], np.maximum.reduceat(z, cuts))
        return out

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        hidden = np.maximum(self.pooled(texts) + self.p["bias"], 0)
        return (hidden @ self.p["out"] + self.p["out_bias"][0]).astype(float)

    def scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if not texts or self.base is not None:
            return np.full(len(texts), self.base or 0.0)
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))

    def flat(self) -> list[np.ndarray]:
        """The weights as ``SLICES`` arrays of rows: embeddings, and in the last one all else, in one row."""
        rest = np.concatenate([self.p[k].ravel() for k in sorted(self.p)])[None]
        return [*np.array_split(self.embed.reshape(-1, PART), SLICES - 1), rest]

    def set_flat(self, parts: list[np.ndarray]) -> None:
        self.embed, at = np.concatenate(parts[:-1]).reshape(self.embed.shape), 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = parts[-1][0, at:at + n].reshape(self.p[k].shape)
            at += n

    def _best(self, full: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and filter, the largest response and where it is; of about ``BLOCK`` positions at once."""
        n, f, more = len(begin), np.arange(self.p["bias"].size), max(WIDTHS) - 1
        where = np.zeros((n, f.size), np.int64)
        top = np.full((n, f.size), -np.inf, np.result_type(self.embed, self.p["conv"]))
        i = 0
        while i < n:
            j = i + 1
            while j < n and ends[j] - begin[i] <= BLOCK:
                j += 1
            for a in range(begin[i], ends[j - 1], BLOCK):  # several texts are one block
                b = min(a + BLOCK, ends[j - 1])
                z = self.responses(full[a:b + more])
                for k in range(i, j):
                    own = z[max(begin[k] - a, 0):ends[k] - a]
                    at = own.argmax(0)
                    better = own[at, f] > top[k]
                    top[k][better] = own[at, f][better]
                    where[k][better] = (max(begin[k], a) + at)[better]
            i = j
        return top, where

    def _gradients(self, texts: list[np.ndarray], target: np.ndarray):
        p, n = self.p, len(texts)
        ids, begin = _stream(texts)
        full = np.concatenate((ids, ids[len(ids) - max(WIDTHS) + 1:]))
        top, where = self._best(full, begin, np.append(begin[1:], len(ids)) - max(WIDTHS) + 1)  # texts, filters
        pooled = top + p["bias"]
        hidden = np.maximum(pooled, 0)
        d = (1 / (1 + np.exp(-np.clip(hidden @ p["out"] + p["out_bias"][0], -30, 30))) - target) / n
        dh = d[:, None] * p["out"] * (pooled > 0)
        at = where[:, :, None] + np.arange(max(WIDTHS))  # texts, filters, taps
        chosen = self.vectors(full[at].ravel()).reshape(*at.shape, -1)
        dconv = np.einsum("nf,nfke->kef", dh, chosen) * self.mask
        by = np.einsum("nf,kef->nfke", dh, p["conv"]).reshape(-1, TABLES * PART)
        return {"conv": dconv, "bias": dh.sum(0), "out": hidden.T @ d, "out_bias": d.sum(keepdims=True)}, (full[at].ravel(), by)


class Training:
    """Adam on the logistic loss; the embeddings' rows by Adagrad, as few of them are met at a time."""

    def __init__(self, model: ConvNet, seed: int):
        self.model, self.rng, self.step = model, np.random.default_rng(seed), 0
        self.m, self.v = ({k: np.zeros_like(x) for k, x in model.p.items()} for _ in range(2))
        self.seen = np.full(model.embed.shape[:2], 1e-4, np.float32)

    def visit(self, texts: list[np.ndarray], target: np.ndarray, slow: float, rate: float = 0.005, embed_rate: float = 0.1) -> None:
        """Once each text, in some order."""
        model, rng, m, v = self.model, self.rng, self.m, self.v
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            pick, self.step = order[at:at + BATCH], self.step + 1
            # without some of its words a text's other words have to tell
            some = [np.where(rng.random(len(texts[k])) < DROPPED, PAD, texts[k]) for k in pick]
            grads, (rows, by) = model._gradients(some, target[pick])
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                lr = rate * slow * np.sqrt(1 - 0.999 ** self.step) / (1 - 0.9 ** self.step)
                model.p[k] -= (lr * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
            for t in range(TABLES):
                some, which = np.unique(_table(rows, t), return_inverse=True)
                g = np.zeros((len(some), PART), np.float32)
                np.add.at(g, which, by[:, t * PART:(t + 1) * PART])
                g[some == BUCKETS] = 0
                self.seen[t, some] += (g * g).mean(1)
                model.embed[t, some] -= embed_rate * slow * g / np.sqrt(self.seen[t, some])[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc, lang, toxic, keep, shard, text) of every document that may be learned from, stored by shard.

    ``keep`` is kept from training.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    n = known.count()
    if n <= BROADCAST:
        known = F.broadcast(known)
    texts = docs.select("doc_id", "lang", "text").join(known, F.col("doc_id") == F.col("id"))
    texts = texts.groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("one"))
    shards = max(1, -(-n // SHARD))
    drawn = lambda salt: F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("long")
    rows = texts.select(F.col("doc_id").alias("doc"), "one.lang", "toxic", (drawn("keep-") < int(KEPT * (1 << 32))).alias("keep"),
                        (drawn("toxic-") % shards).cast("int").alias("shard"), drawn("order-").alias("place"), "one.text")
    path = new_folder(spark, "toxicity")
    rows.repartition(shards, "shard").sortWithinPartitions("shard", "place", "doc").write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def frequent(rows: DataFrame, least: int) -> np.ndarray:
    """The words of at least ``least`` documents, in order.  A text has few words next to a share of all texts."""
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found = [np.unique(t) for t in word_ids(batch.column(0).slice(at, 256))]
                word, docs = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(docs.astype(np.int64))], ["word", "docs"])

    counted = rows.select("text").mapInArrow(words, "word long, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    return np.sort(counted.where(F.col("docs") >= least).select("word").toArrow().column("word").to_numpy().astype(np.uint64))


def trained_once(rows: DataFrame, model: ConvNet, words: np.ndarray, each: int, epochs: int, done: float, todo: float) -> ConvNet:
    """The model after ``epochs`` visits of all rows by ``each`` copies a shard: the share ``todo`` of the training, after ``done``."""
    shared = rows.sparkSession.sparkContext.broadcast((model, words))  # some megabytes

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, common = shared.value
        before = [x.copy() for x in start.flat()]
        shard, training, n, held, texts, target = None, None, 0, 0, [], []

        def work():
            for epoch in range(epochs if texts else 0):
                training.visit(texts, np.array(target, np.float32), 1 - done - todo * epoch / epochs)
            texts.clear()
            target.clear()

        def changes():
            parts = [(x - y).astype(np.float32).tobytes() for x, y in zip(training.model.flat(), before)]
            columns = (range(SLICES), pa.int32()), ([shard] * SLICES, pa.int32()), ([n] * SLICES, pa.int64()), (parts, pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(*c) for c in columns], ["slice", "shard", "docs", "part"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for of, toxic, ids in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), word_ids(some.column(2))):
                    if of != shard:
                        if n:
                            work()
                            yield changes()
                        shard, n, held = of, 0, 0
                        copy = ConvNet()
                        copy.set_flat([x.copy() for x in before])
                        training = Training(copy, 12 + of)
                    # words of few documents only teach their labels by heart; their stems may be common
                    at_word = np.minimum(np.searchsorted(common, ids), max(0, len(common) - 1))
                    rare = common[at_word] != ids if len(common) else np.ones(len(ids), bool)
                    texts.append(np.where(rare, ids & _STEMS | PAD & ~_STEMS, ids))
                    target.append(toxic)
                    n, held = n + 1, held + len(ids)
                    if held > CHUNK:
                        work()
                        held = 0
        if n:
            work()
            yield changes()

    def average(table: pa.Table) -> pa.Table:
        table = table.sort_by([("shard", "ascending"), ("docs", "ascending")])
        last = table.column("slice")[0].as_py() == SLICES - 1
        total, weight = 0.0, 0.0
        for docs, part in zip(table.column("docs").to_pylist(), table.column("part").to_pylist()):
            change = np.frombuffer(part, np.float32).astype(float).reshape(1 if last else -1, -1 if last else PART)
            total = total + docs * change
            weight = weight + docs * (np.ones((1, 1)) if last else (change != 0).any(1, keepdims=True))
        part = (total / np.maximum(weight, 1)).astype(np.float32).tobytes()
        return pa.table({"slice": pa.array([table.column("slice")[0].as_py()], pa.int32()), "part": pa.array([part], pa.binary())})

    # every copy of a shard reads it by itself, in a task of its own
    copies = reduce(DataFrame.unionByName, [rows.select((F.col("shard") * each + k).alias("shard"), "toxic", "text") for k in range(each)])
    changed = copies.mapInArrow(learn, "slice int, shard int, docs long, part binary")
    found = changed.groupBy("slice").applyInArrow(average, "slice int, part binary").toArrow()
    parts = dict(zip(found.column("slice").to_pylist(), found.column("part").to_pylist()))
    out = ConvNet()
    out.set_flat([x + np.frombuffer(parts[k], np.float32).reshape(x.shape) for k, x in enumerate(model.flat())])
    return out


def best_threshold(scores: np.ndarray, toxic: np.ndarray, docs: np.ndarray | None = None) -> float:
    """The logit between the two scores whose parting gives the best F1; ``toxic`` of ``docs`` (one) have a score."""
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(toxic[order])
    upto = np.arange(1, len(s) + 1) if docs is None else np.cumsum(docs[order])
    f1 = 2 * hit / (upto + toxic.sum())
    f1[:-1][s[:-1] == s[1:]] = -1  # equal scores are not parted
    k = int(f1.argmax())
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k]) - 1


def thresholds(kept: DataFrame, model: ConvNet) -> dict[str, float]:
    """By language, of those with enough toxic documents: counted over all that were kept."""
    enough = kept.where(F.col("lang").isNotNull()).groupBy("lang").agg(F.sum("toxic").alias("n")).where(F.col("n") >= LANG_TOXIC).select("lang")
    rows = with_scores(kept.join(enough, "lang"), model, "score")
    step = F.floor(F.ln(F.col("score") / (1 - F.col("score"))) * GRID).alias("step")
    found = rows.groupBy("lang", step).agg(F.sum("toxic").alias("toxic"), F.count("*").alias("docs")).toPandas()
    out = {}
    for lang, own in found.groupby("lang"):
        logit = best_threshold((own["step"].to_numpy(float) + 0.5) / GRID, own["toxic"].to_numpy(float), own["docs"].to_numpy(float))
        out[lang] = float(1 / (1 + np.exp(-logit)))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> ConvNet:
    rows, model = labelled(docs, labels), ConvNet()
    count = {(r["keep"], r["toxic"]): r["n"] for r in rows.groupBy("keep", "toxic").agg(F.count("*").alias("n")).collect()}
    n, kinds = sum(count.values()), {t for _, t in count}
    if len(kinds) < 2:
        model.base = float(max(kinds, default=0))
        return model
    keep = all((True, t) in count for t in kinds)
    train = rows.where(~F.col("keep")) if keep else rows
    words, shards = frequent(rows, 2 + n // 1000), max(1, -(-n // SHARD))
    learned = sum(v for (kept, _), v in count.items() if not (keep and kept))
    epochs, rounds = int(np.clip(VISITS // max(1, learned), 2, 50)), 1 if shards == 1 else ROUNDS
    for r in range(rounds):
        model = trained_once(train, model, words, -(-COPIES // shards), epochs, r / rounds, 1 / rounds)
    model.settle()
    if keep:
        model.by_lang = thresholds(rows.where("keep"), model)
    return model


def with_scores(docs: DataFrame, model: ConvNet, into: str) -> DataFrame:
    """``docs`` with a column ``into``: the score of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # about two megabytes

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [shared.value.scores(word_ids(texts.slice(at, 256))) for at in range(0, len(texts), 256)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    scored.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf("double")(scored)(F.col("text")))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, toxic) of every row of ``docs`` (doc_id, text, lang).

    predicted: by the common threshold, 0.3; toxic: by the one of the row's language.
    """
    model = fit(docs, labels)
    into = fresh_name(docs, "toxicity")
    found = with_scores(docs.select("doc_id", "lang", "text"), model, into)
    threshold = F.lit(THRESHOLD)
    if model.by_lang:
        table = F.create_map(*[F.lit(x) for item in sorted(model.by_lang.items()) for x in item])
        threshold = F.coalesce(F.try_element_at(table, F.col("lang")), threshold)
    score = F.col(into)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
                        (score >= THRESHOLD).cast("int").alias("predicted"), threshold.alias("threshold"),
                        (score >= threshold).cast("int").alias("toxic"))
