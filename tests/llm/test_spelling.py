import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from ledgerloom.llm import spelling


def brute(rows, drop_every=97):
    n = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            if (short := w[:i] + w[i + 1:]) in n:
                near[w].add(short), near[short].add(w)
            for c in "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))):
                if c != w[i] and (other := w[:i] + c + w[i + 1:]) in n:
                    near[w].add(other)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def some_docs(seed=3, docs=60):
    rnd = random.Random(seed)
    base = ["".join(rnd.choices("abeÿ", k=rnd.choice((5, 6, 9, 17)))) for _ in range(150)] + ["straße", "Ärger", "aaaaa", "aaaaaa", "baaaa"]
    rows = [(d, " ".join(rnd.choices(base, k=120)) + ".") for d in range(docs)]
    return rows + [(1, None), (2, ""), (None, "hello Hello HELLO hallo hello hello"), (5, rows[5][1]), (7, "x" * 400 + " " + "x" * 400 + "," + "x" * 400)]


@pytest.mark.parametrize("cell", [32_768, 12])
def test_against_all_pairs(docs_of, monkeypatch, cell):
    """With small cells: trees, words without a split, blocks of held and of asked words."""
    monkeypatch.setattr(spelling, "CELL", cell)
    rows = some_docs()
    out = spelling.variants(docs_of(rows), drop_every=7).collect()
    assert len(out) == len({r.word for r in out})
    assert {tuple(r) for r in out} == brute(rows, 7)


def test_empty(docs_of):
    assert spelling.variants(docs_of([])).collect() == []
    assert spelling.variants(docs_of([(1, None), (2, "a b c")])).collect() == []


def test_long_chains_of_forms(docs_of):
    words = ["aaaaa" + "b" * k for k in range(8)]
    rows = [(k, " ".join([w] * (3 << k))) for k, w in enumerate(words)]
    out = {r.word: r for r in spelling.variants(docs_of(rows)).collect()}
    assert all(out[w].root == words[-1] for w in words)
    assert out[words[-1]].form is None and out[words[0]].form == words[1]


def test_pieces_of_a_long_text_cut_no_run():
    text = ("éa" * 700 + " b×c 1é āx ") * 9
    raw = text.encode()
    whole = spelling.RUN.findall(raw)
    assert [r for p in spelling.pieces(raw, 64) for r in spelling.RUN.findall(p)] == whole
    assert [r.decode() for r in whole] == re.findall("[a-zÀ-ÿ]+", text)


def test_tree_reaches_all_within_the_box():
    rng = np.random.default_rng(1)
    v = np.zeros((300, spelling.LETTERS), np.uint8)
    v[:, :4] = rng.integers(0, 4, (300, 4))
    tree = spelling.Tree.over(v, 8)
    got = defaultdict(set)
    for leaf, rows in tree.reach(v, 1, 1):
        for r in rows:
            got[r] |= set(tree.held[leaf].tolist())
    for r in range(300):
        d = v.astype(int) - v[r]
        wanted = np.flatnonzero((np.maximum(d, 0).sum(1) <= 1) & (np.maximum(-d, 0).sum(1) <= 1))
        assert set(wanted.tolist()) <= got[r]
