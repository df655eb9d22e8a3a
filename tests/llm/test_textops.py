import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ledgerloom.llm.textops import ALNUM, SPACED, chunks, shingles, word_hash

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
TEXT = st.text(alphabet="aAbZ09 \t\n\x0b.-é漢\u00a0\x1f", max_size=40)


def expected(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.integers(1, 60))
def test_words_are_those_of_the_pattern_in_chunks_of_any_size(texts, size):
    for table, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got = []
        for at, w in chunks(pa.array(texts, pa.string()), table, size):
            assert at == len(got)
            got += [[int(h) for h in w.hash[w.first[i]:w.first[i + 1]]] for i in range(w.n_docs)]
        assert got == [[word_hash(x) for x in expected(t, pattern)] for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(2, 4))
def test_shingles_are_equal_exactly_when_the_words_are(texts, width):
    (_, w), = chunks(pa.array(texts), SPACED)
    h, doc = shingles(w, width)
    seen = {}
    for i, t in enumerate(texts):
        ws = expected(t, r"[^\x20\x09-\x0D]+")
        want = [tuple(ws)] if 0 < len(ws) < width else [tuple(ws[k:k + width]) for k in range(len(ws) - width + 1)]
        mine = [int(x) for x in h[doc == i]]
        assert len(mine) == len(want)
        for a, b in zip(mine, want):
            assert seen.setdefault(a, b) == b
    assert len(set(seen.values())) == len(seen)


def test_a_slice_of_a_batch_is_read_at_its_offset():
    part = pa.array(["one", "two three", None, "four"]).slice(1, 3)
    assert [list(w.counts) for _, w in chunks(part, SPACED)] == [[2, 0, 1]]
    assert np.array_equal(next(iter(chunks(part, SPACED)))[1].hash[:1], [np.uint64(word_hash("two"))])
