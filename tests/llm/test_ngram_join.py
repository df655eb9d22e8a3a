import random
import re

import numpy as np
import pytest

from ledgerloom.llm import minhash, ngram_join
from ledgerloom.llm.components import components

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sets(rows, width):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append({tuple(w)} if 0 < len(w) < width else {tuple(w[k:k + width]) for k in range(len(w) - width + 1)})
    return out


def brute(rows, width, num, den):
    """doc_id -> (set size, smallest doc_id reachable) by comparing all pairs."""
    s, root = sets(rows, width), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and den * len(s[i] & s[j]) >= num * len(s[i] | s[j]):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    ids = {}
    for (d, _), r in zip(rows, root):
        ids[r] = min(ids.get(r, d), d)
    return {d: (len(x), ids[r]) for (d, _), x, r in zip(rows, s, root)}


def corpus(seed, n=60):
    """Texts with exact copies, near copies at all distances, shared passages and short texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 40
    passage = rnd.choices(vocabulary, k=30)
    texts = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.35 or not texts:
            w = rnd.choices(vocabulary, k=rnd.randint(1, 120))
            if rnd.random() < 0.5:
                w += passage
        else:
            w = rnd.choice(texts).split()
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        texts.append(" ".join(w))
    return [(i * 3 + 1, t.upper() if rnd.random() < 0.2 else t) for i, t in enumerate(texts)]


def found(df, **kw):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.jaccard_components(df, **kw).collect()}


@pytest.mark.parametrize("width,num,den", [(3, 90, 100), (5, 80, 100)])
def test_components_equal_those_of_all_pairs(docs_of, width, num, den):
    rows = corpus(width) + [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two")]
    assert found(docs_of(rows), width=width, num=num, den=den) == brute(rows, width, num, den)


def test_units_of_many_blocks_lose_no_link(docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 150)
    rows = corpus(11, 40)
    assert found(docs_of(rows), width=3, num=80, den=100) == brute(rows, 3, 80, 100)


@pytest.mark.parametrize("seed", range(4))
def test_tree_links_connect_what_all_pairs_connect(seed):
    rnd = np.random.default_rng(seed)
    base = rnd.integers(0, 1 << 63, (6, 400), dtype=np.uint64)
    made = []
    for _ in range(150):
        s = base[rnd.integers(6)][:rnd.integers(20, 400)].copy()
        s[rnd.random(len(s)) < rnd.choice([0, 0.02, 0.06, 0.2])] += np.uint64(rnd.integers(1, 9))
        made.append(np.unique(s))
    unit = rnd.integers(0, 3, len(made))
    order = np.lexsort(([len(s) for s in made], unit))
    unit, made = unit[order], [made[i] for i in order]
    links = ngram_join.SignatureTree(unit, made, 9, 10).links(np.arange(len(made)))

    def roots(pairs):
        r = list(range(len(made)))
        for a, b in pairs:
            r = [min(r[a], r[b]) if x in (r[a], r[b]) else x for x in r]
        return r
    every = [(i, j) for i in range(len(made)) for j in range(i) if unit[i] == unit[j]
             and 10 * len(np.intersect1d(made[i], made[j])) >= 9 * len(np.union1d(made[i], made[j]))]
    assert roots(links) == roots(every)


def test_empty_table_and_repeated_rows(docs_of):
    assert found(docs_of([])) == {}
    assert ngram_join.keep_one(docs_of([])).count() == 0
    df = docs_of([(5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (9, "z"), (None, "q r s")])
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_join.jaccard_components(df).collect()), key=str)
    assert got == [(2, 2), (5, 2), (5, 2), (9, 9), (None, None)]
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 9, None]


def test_one_doc_id_in_very_many_rows(docs_of):
    text = " ".join(f"w{i}" for i in range(50))
    near = text.replace("w49", "x")
    df = docs_of([(4, text)] * 300 + [(9, near), (11, near), (4, "a b c d e f g"), (2, "a b c d e f g")])
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngram_join.jaccard_components(df, width=3, num=90, den=100).collect()}
    assert got == {(4, 48): 4, (9, 48): 4, (11, 48): 4, (4, 5): 2, (2, 5): 2}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3), (200, 100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in [*range(100, 130), 200]}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_banded_fingerprints_find_the_near_copies(docs_of):
    rows = corpus(23) + [(900, None), (901, "one"), (902, "one")]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_copy_classes(docs_of(rows)).collect()}
    want = {d: r for d, (_, r) in brute(rows, 5, 80, 100).items()}
    assert {d for d in got if got[d] != d} <= {d for d in want if want[d] != d}
    missed = [d for d in want if got[d] != want[d]]
    assert len(missed) <= 0.1 * sum(want[d] != d for d in want)


def test_keep_one_with_dotted_names_and_rows_of_one_doc_id(spark):
    base = [f"w{i} " for i in range(60)]
    rows = [(1, "".join(base), 0.5), (2, "".join(base[1:]), 0.5), (3, "x y z", None), (3, "".join(base), 1.0), (None, "".join(base), 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` double")
    out = ngram_join.keep_one(docs, 5, 80, 100)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[0], rows[2]], key=str)


def test_texts_of_one_doc_id_go_to_the_units_of_their_own_sets(spark):
    """Pairs of near copies whose first texts all bear one doc_id: as many links as with ids of their own."""
    pairs = [[" ".join(f"p{k}w{i}" for i in range(40)), " ".join(f"p{k}w{i}" for i in range(1, 40))] for k in range(30)]
    rows = [(7, a) for a, _ in pairs] + [(100 + k, b) for k, (_, b) in enumerate(pairs)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngram_join.row_components(docs, "doc_id", "text", 3, 90, 100)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(7, 7)} | {(100 + k, 7) for k in range(30)}
    assert found.select("root").distinct().count() == 30
