"""Language identification with a byte convolutional network, trained in numpy.

Bytes are embedded; filters of several widths slide over fixed-length windows; each filter's
maximum over the window feeds a softmax over the learned languages.  A text is covered by
windows of ``WINDOW`` bytes from beginning to end (each overlaps the next by the filter
width, so no filter position is lost); its probabilities are the windows' mean, weighted by
their bytes.

Training takes a bounded sample: of every language ``DOCS_PER_LANG`` documents, or less where
there are so many languages that all would be more than ``MOST_DOCS`` (one at least), drawn by a
hash of their doc_id (one text of a repeated one), and up to ``WINDOWS_PER_DOC`` evenly spaced
windows of each.  Only text and
non-null lang of documents with ``crc32(doc_id) mod 3 <> 1`` are learned from; the network
sees bytes alone.  A null doc_id is neither learned from nor held out.

In use, the first layers fold into two tables indexed by byte pairs, so a filter bank's
response is the sum of two table rows.

A text that is null or has no letter is ``und`` with score 0; so is every text if nothing can
be learned.  Repeated rows are judged alike; an empty table gives an empty one.

As a pipeline stage (``keep_known``) the network learns one class more: texts without a language
(``noise.py``).  A text goes if that class is likelier than a limit, which is a half or what nearly
all (``PASSING``) of the sample's labelled texts stay below, whichever is more.  The shorter a
text, the less it says, so there is a limit for each of several lengths, from pieces of that length.
From 64 bytes on a limit is at most ``SURE``, so that rows with a wrong label cannot lift it to where
nothing goes; a share of such rows may then take more than ``1 - PASSING`` of the labelled texts.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .noise import noise
from .storage import fresh_name, saved

WINDOW = 256
TAPS = 4
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
EMBED = 8
DOCS_PER_LANG = 400
MOST_DOCS = 100_000
WINDOWS_PER_DOC = 6
EPOCHS = 8
BATCH = 128
PASSING = 0.995  # share of the labelled texts that is to pass
SURE = 0.9  # a limit of long texts is never above
PIECES = (8, 16, 32, 64, 128, WINDOW)  # bytes of the pieces that the limits are set by
LEAST_ROWS, MOST_NOISE = 4000, 20_000  # rows of a reject class's training
TRIALS = 2000  # labelled pieces of each length


class ByteCNN:
    def __init__(self, labels: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        n = FILTERS * len(WIDTHS)
        self.labels = labels
        self.limits = None  # per length of PIECES, with a last class for texts without a language
        self.mask = np.zeros((TAPS, 1, n), np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[:width, :, k * FILTERS:(k + 1) * FILTERS] = 1
        f32 = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"embed": f32(0.5, 256, EMBED), "conv": f32(0.3, TAPS, EMBED, n) * self.mask, "bias": np.zeros(n, np.float32),
                  "out": f32(0.2, n, len(labels)), "out_bias": np.zeros(len(labels), np.float32)}

    def train(self, windows: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, seed: int = 6) -> None:
        """Adam on the cross entropy of (rows of WINDOW bytes, label indices)."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                pick = order[at:at + BATCH]
                grads, step = self._gradients(windows[pick], target[pick]), step + 1
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    lr = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                    self.p[k] -= (lr * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)

    def _gradients(self, x: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        e = p["embed"][x]
        t = x.shape[1] - TAPS + 1
        cols = np.concatenate([e[:, k:k + t] for k in range(TAPS)], 2)  # n, t, TAPS * EMBED
        z = cols.reshape(n * t, -1) @ p["conv"].reshape(-1, p["conv"].shape[2])
        z = z.reshape(n, t, -1)
        where = z.argmax(1)  # n, filters
        rows, filters = np.arange(n)[:, None], np.arange(z.shape[2])[None, :]
        pooled = z[rows, where, filters] + p["bias"]
        hidden = np.maximum(pooled, 0)
        logits = hidden @ p["out"] + p["out_bias"]
        d = np.exp(logits - logits.max(1, keepdims=True))
        d /= d.sum(1, keepdims=True)
        d[np.arange(n), target] -= 1
        d /= n
        dh = (d @ p["out"].T) * (pooled > 0)
        chosen = cols[rows, where]  # n, filters, TAPS * EMBED
        dconv = np.einsum("nf,nfc->cf", dh, chosen).reshape(p["conv"].shape) * self.mask
        dcols = np.einsum("nf,kef->nfke", dh, p["conv"])
        dembed = np.zeros_like(p["embed"])
        np.add.at(dembed, x[rows[:, :, None], where[:, :, None] + np.arange(TAPS)], dcols)
        return {"embed": dembed, "conv": dconv, "bias": dh.sum(0), "out": hidden.T @ d, "out_bias": d.sum(0)}

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses by the first and by the second pair of a position's four bytes."""
        one = np.einsum("be,kef->kbf", self.p["embed"], self.p["conv"])
        pair = lambda a, b: (one[a][:, None] + one[b][None, :]).reshape(1 << 16, -1)
        return pair(0, 1), pair(2, 3)

    def probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        pairs = windows[:, :-1].astype(np.int64) << 8 | windows[:, 1:]
        z = tables[0][pairs[:, :-2]]
        z += tables[1][pairs[:, 2:]]
        hidden = np.maximum(z.max(1) + self.p["bias"], 0)
        logits = hidden @ self.p["out"] + self.p["out_bias"]
        e = np.exp(logits - logits.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def judge(self, texts: list[bytes], tables) -> np.ndarray:
        """Per text, the mean probabilities of its windows; zeros for an empty text."""
        out = np.zeros((len(texts), len(self.labels)))
        rows, owner, weight = [], [], []

        def flush():
            if rows:
                x = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WINDOW)
                np.add.at(out, owner, self.probabilities(x, tables) * np.array(weight)[:, None])
                rows.clear(), owner.clear(), weight.clear()

        for i, text in enumerate(texts):
            for w in windows_of(text):
                rows.append(w.ljust(WINDOW, b"\0"))
                owner.append(i)
                weight.append(len(w))
                if len(rows) == 64:
                    flush()
        flush()
        return out / np.maximum(out.sum(1, keepdims=True), 1e-12)


def windows_of(text: bytes) -> list[bytes]:
    """Pieces of WINDOW bytes, each beginning TAPS - 1 bytes before the end of the one before."""
    step = WINDOW - TAPS + 1
    return [text[i:i + WINDOW] for i in range(0, max(1, len(text) - TAPS + 1), step)] if text else []


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sampled(docs: DataFrame) -> pa.Table:
    """(doc, k, lang, raw): windows of a bounded sample of the labelled documents."""
    known = docs.select("doc_id", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # distinct ids per language first, so that repeated rows neither fill nor multiply the sample
    known = known.distinct().withColumn("h", F.xxhash64("doc_id"))
    langs = saved(known.groupBy("lang").agg(F.count("*").alias("docs"), F.min("h").alias("least")))
    n_langs = langs.count()
    each = max(1, min(DOCS_PER_LANG, MOST_DOCS // max(1, n_langs)))
    if n_langs <= MOST_DOCS:  # one row a language: no language's rows are dealt to one task
        langs = F.broadcast(langs)
    # a draw of about twice as many, and the least of each language, before its rows come together
    draw = F.pmod("h", F.lit(1 << 32)) / float(1 << 32)
    known = known.join(langs, "lang").where((F.col("h") == F.col("least")) | (draw * F.col("docs") < 2 * each + 16))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("h") != F.col("least"), F.md5(F.col("doc_id").cast("string")), "doc_id"))
    known = known.withColumn("place", place).where(F.col("place") <= each)
    known = saved(known.select(F.col("doc_id").alias("id"), F.col("lang").alias("of")))
    if n_langs <= MOST_DOCS:  # so at most as many rows
        known = F.broadcast(known)
    texts = docs.select("doc_id", "lang", "text").join(known, (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("of")))
    texts = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if has_letter(text):
                    raw = windows_of(text.encode())
                    picks = sorted({len(raw) * k // WINDOWS_PER_DOC for k in range(WINDOWS_PER_DOC)})
                    rows += [(doc, k, lang, raw[k].ljust(WINDOW, b"\0")) for k in picks]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds)], ["doc", "k", "lang", "raw"])

    return texts.mapInArrow(cut, "doc long, k long, lang string, raw binary").toArrow().sort_by([("lang", "ascending"), ("doc", "ascending"), ("k", "ascending")])


def _rows(pieces: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(WINDOW, b"\0") for p in pieces), np.uint8).reshape(-1, WINDOW)


def fit(docs: DataFrame, reject: bool = False) -> ByteCNN | None:
    """A network trained on a bounded sample of ``docs``; None if there is nothing to learn.

    reject: with a last class for texts without a language, and limits for it.
    """
    sample = sampled(docs)
    if not len(sample):
        return None
    labels, target = np.unique(np.array(sample.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    raw = sample.column("raw").to_pylist()
    if not reject:
        model = ByteCNN(labels.tolist())
        model.train(_rows(raw), target)
        return model
    model = ByteCNN([*labels.tolist(), "und"])
    rnd = random.Random(7)
    raw = [r.rstrip(b"\0") for r in raw]

    def piece(text: bytes, n: int) -> bytes:
        at = rnd.randint(0, max(0, len(text) - n))
        return text[at:at + n]

    some = lambda: int(2 ** rnd.uniform(3, 8))
    picks = list(range(len(raw))) + [rnd.randrange(len(raw)) for _ in range(max(len(raw) // 2, LEAST_ROWS - len(raw)))]
    # pieces of texts; in half of them keys, numbers or the like stand beside words, which is a language still
    clean = raw + [piece(raw[i], some()) for i in picks[len(raw):]]
    for k in range(len(raw), len(clean), 2):
        beside = noise(rnd, "", rnd.randint(4, 16 + len(clean[k])))
        clean[k] = b" ".join((beside, clean[k]) if rnd.random() < 0.5 else (clean[k], beside))[:WINDOW]
    bad = [noise(rnd, raw[i].decode(errors="ignore"), some() if k % 3 == 0 else WINDOW)
           for k, i in enumerate(rnd.choices(picks, k=min(len(picks), MOST_NOISE)))]
    model.train(_rows(clean + bad), np.r_[target[picks], np.full(len(bad), len(labels))])
    tables = model.tables()
    model.limits = []
    for n in PIECES:
        tried = [piece(r, n) for r in rnd.sample(raw, min(TRIALS, len(raw)))]
        limit = max(0.5, float(np.quantile(model.judge(tried, tables)[:, -1], PASSING, method="higher")))
        # mislabelled rows must not lift it to where nothing goes; short pieces do say too little
        model.limits.append(min(limit, SURE) if n >= 64 else limit)
    return model


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def with_language(docs: DataFrame, model: ByteCNN | None, into: str) -> DataFrame:
    """``docs`` with a struct ``into`` of lang_pred and score."""
    if model is None:
        return docs.withColumn(into, F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score")))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few kilobytes

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        tables = model.tables()
        for texts in batches:
            langs, scores = [], []
            for at in range(0, len(texts), 256):
                part = texts.slice(at, 256).to_pylist()
                raw = [t.encode() if has_letter(t) else b"" for t in part]
                p = model.judge(raw, tables)
                known = p.max(1) > 0
                if model.limits is not None:
                    size = np.searchsorted(PIECES, [len(r) for r in raw], "right") - 1
                    known &= p[:, -1] <= np.array(model.limits)[np.maximum(size, 0)]
                    p = p[:, :-1]
                best = p.argmax(1)
                langs += [model.labels[b] if k else "und" for b, k in zip(best, known)]
                scores += np.minimum(p.max(1), 1.0).tolist()
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    judged.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn(into, F.arrow_udf("lang_pred string, score double")(judged)(F.col("text")))


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    into = fresh_name(docs, "language")
    found = with_language(docs.select("doc_id", "text"), fit(docs), into)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), f"{into}.lang_pred", f"{into}.score")


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a language: a text with a letter that the network does not
    take for one without any.  If nothing can be learned, every text with a letter stays."""
    model = fit(docs, reject=True)
    if model is None:
        return docs.where(F.arrow_udf("boolean")(_lettered)(F.col("text")))
    into = fresh_name(docs, "language")
    found = with_language(docs, model, into)
    return found.where(f"{into}.lang_pred <> 'und'").drop(into)


def _lettered(texts: pa.Array) -> pa.Array:
    return pa.array([has_letter(t) for t in texts.to_pylist()], pa.bool_())
