import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import toxicity

BAD = ["vilewort", "grubsnake", "mudface"]
FIRST = "bcdfgklmnprstvwz"


def some(n, seed=1):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(FIRST) + rnd.choice("aeiou") for _ in range(rnd.choice((2, 3))))
    words, docs, labels = [word() for _ in range(400)], [], []
    for d in range(n):
        text, bad = rnd.choices(words, k=rnd.choice((3, 30, 200))), d % 4 == 0
        if bad:
            for _ in range(rnd.choice((1, 3))):
                text.insert(rnd.randrange(len(text)), rnd.choice(BAD))
        docs.append((d, " ".join(text), rnd.choice(("aa", "bb", None))))
        labels.append((d, int(bad)))
    return docs, labels


@pytest.fixture(scope="module")
def judged(spark, docs_of):
    docs, labels = some(700)
    odd = [(9000, None), (9001, ""), (9002, "... !!"), (None, "grubsnake badi"), (9003, "bada " * 200_000 + "vilewort " + "bada " * 200_000),
           (9004, "bada " * 400_000), (9005, "GRUBSNAKE, mudface"), (9005, "GRUBSNAKE, mudface"), (9006, "zuzu")]
    table = docs_of(docs + odd)
    known = spark.createDataFrame([*labels, (9003, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    return docs, dict(labels), toxicity.predict(table, known).collect()


def test_held_out_documents(judged):
    docs, labels, rows = judged
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert {r.doc_id for r in held} == {d for d in labels if crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95
    assert np.mean([r.toxic == labels[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.toxic == int(r.score >= r.threshold) for r in rows)


def test_odd_rows(judged):
    rows = judged[2]
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert len(rows) == 709 and len(of[9005]) == 2 and of[9005][0] == of[9005][1]
    assert of[9000][0].score == of[9001][0].score == of[9002][0].score and of[9000][0].predicted == 0
    assert not of[None][0].held_out and of[None][0].predicted == 1 and of[9005][0].predicted == 1
    # one telling word in the middle of two megabytes
    assert of[9003][0].predicted == 1 and of[9004][0].predicted == 0


def test_nothing_to_learn(spark, docs_of):
    docs, labels = some(40)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.predict(docs_of(docs), none).collect()} == {(0.0, 0)}
    held = [(d, t) for d, t in labels if crc32(str(d).encode()) % 4 == 2]
    assert {r.score for r in toxicity.predict(docs_of(docs), spark.createDataFrame(held, "doc_id long, toxic int")).collect()} == {0.0}
    alike = spark.createDataFrame([(d, 1) for d, _ in labels], "doc_id long, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.predict(docs_of(docs), alike).collect()} == {(1.0, 1)}
    assert toxicity.predict(docs_of([]), alike).collect() == []


def test_pooling_in_blocks_is_that_of_whole_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    model = toxicity.ConvNet()
    texts = toxicity.word_ids(pa.array(["a b c d e f g h i j k l m n o p", None, "", "x", "one two", "q r s t u v w x y z a b"]))
    got = model.pooled(texts)
    for text, row in zip(texts, got):
        e = np.concatenate([model.vectors(text), np.zeros((4, toxicity.TABLES * toxicity.PART))])
        n = max(1, len(text) + 2)
        want = np.max([sum(e[i + k] @ model.p["conv"][k] for k in range(3)) for i in range(n)], 0)
        np.testing.assert_allclose(row, want, atol=1e-4)


def test_gradients_are_those_of_the_loss():
    model = toxicity.ConvNet()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    texts = toxicity.word_ids(pa.array(["ab cd ef gh", "ij kl", "mn op qr st uv"]))
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        z = np.maximum(np.concatenate([_pool(model, t) for t in texts]) + model.p["bias"], 0) @ model.p["out"] + model.p["out_bias"][0]
        return np.mean(np.log1p(np.exp(-z)) * y + np.log1p(np.exp(z)) * (1 - y))

    grads, _ = model._gradients(texts, y)
    rng = np.random.default_rng(0)
    for k, g in grads.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in g.shape)
            was = model.p[k][at]
            model.p[k][at] = was + 1e-5
            up = loss()
            model.p[k][at] = was - 1e-5
            down = loss()
            model.p[k][at] = was
            if k != "conv" or model.mask[at[0], 0, at[2]]:
                assert abs((up - down) / 2e-5 - g[at]) < 1e-4


def _pool(model, text):
    ids, _ = toxicity._stream([text])
    ids = np.concatenate((ids, ids[-2:]))
    return model.responses(ids)[:-2].max(0)[None]


def test_threshold_of_the_best_parting():
    s, y = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([1, 1, 0, 1, 0])
    assert toxicity.best_threshold(s, y) == -0.5
    assert toxicity.best_threshold(np.array([1.0, 1.0, 0.0]), np.array([1, 0, 0])) == 0.5


def test_every_labelled_document_is_learned_from(spark, docs_of, monkeypatch):
    """Also those that one shard does not take, and toxic texts whose telling word stands deep in thousands of words."""
    docs, labels = some(300)
    filler = "pada " * 1200
    far = [(1000 + k, filler + "deepword " + filler if k % 2 else filler * 2, "aa") for k in range(60)]
    table, known = docs_of(docs + far), spark.createDataFrame([*labels, *((1000 + k, k % 2) for k in range(60))], "doc_id long, toxic int")
    judged = toxicity.predict(table, known).collect()
    far_scores = [[r.score for r in judged if r.doc_id >= 1000 and r.doc_id % 2 == k] for k in (0, 1)]
    assert min(far_scores[1]) > max(far_scores[0]) + 0.3
    monkeypatch.setattr(toxicity, "SHARD", 50)
    rows = toxicity.labelled(table, known)
    assert {r.doc for r in rows.collect()} == {d for d, *_ in docs + far if crc32(str(d).encode()) % 4 != 2}
    assert rows.select("shard").distinct().count() > 3
    model = toxicity.ConvNet()
    words = toxicity.frequent(rows, 2)
    monkeypatch.setattr(toxicity, "CHUNK", 4000)
    moved = toxicity.trained_once(rows, model, words, 2, 2, 0.0, 0.5)
    assert np.isfinite(moved.embed).all() and (moved.embed != model.embed).any() and not moved.embed[:, toxicity.BUCKETS].any()
    again = toxicity.trained_once(rows, model, words, 2, 2, 0.0, 0.5)
    assert all((x == y).all() for x, y in zip(moved.flat(), again.flat()))


def test_best_responses_in_blocks(monkeypatch):
    model = toxicity.ConvNet()
    texts = toxicity.word_ids(pa.array(["a b c d e f g h i j k l m n o p", None, "x", "one two", "q r s t u v w x y z a b"]))
    ids, begin = toxicity._stream(texts)
    full, ends = np.concatenate((ids, ids[-2:])), np.append(begin[1:], len(ids)) - 2
    want = model._best(full, begin, ends)
    monkeypatch.setattr(toxicity, "BLOCK", 5)
    for a, b in zip(want, model._best(full, begin, ends)):
        np.testing.assert_allclose(a, b, atol=1e-5)


def test_threshold_of_counted_scores():
    assert toxicity.best_threshold(np.array([2.0, 1.0, 0.0]), np.array([3, 2, 0]), np.array([3, 3, 9])) == 0.5
