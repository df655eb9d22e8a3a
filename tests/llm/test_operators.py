import base64
import hashlib
import io
import math
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerloom.llm import chat, langid, licenses, minhash, mixing, packing, topk, urlfilter, warc
from ledgerloom.llm.storage import new_folder

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORDS = "alpha beta gamma delta über the of and".split()


def some_texts(n, seed=1):
    rnd = random.Random(seed)
    return [" ".join(rnd.choices(WORDS, k=rnd.randint(1, 60))) for _ in range(n)]


# ---- mixing ----------------------------------------------------------------
def targets(sizes, share=1.5, cap=2):
    """Rounds of sharing out, as stated."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    got, free, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        give = {s: left * weight[s] / total for s in free}
        left = 0.0
        for s, g in give.items():
            got[s] += g
            if got[s] > cap * sizes[s]:
                left += got[s] - cap * sizes[s]
                got[s] = cap * sizes[s]
                free.discard(s)
    return got


def test_mix_targets_and_copies(docs_of):
    rnd = random.Random(3)
    rows = [(i, t, "en", rnd.choice(["a", "a", "a", "b", "Z", "é", "漢", None])) for i, t in enumerate(some_texts(300))]
    rows += [(400, None, "en", "empty"), (401, "", "en", "empty"), (None, "one two", "en", "a")]
    docs = docs_of(rows)
    got = mixing.taken_copies(docs, "mix").select("doc_id", "text", "source", "mix.*").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = targets(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["copies"] in {int(r["target"] // max(r["source_size"], 1)), int(r["target"] // max(r["source_size"], 1)) + 1} and r["copies"] <= 2
    assert sum(r["size"] * r["copies"] for r in got) == pytest.approx(1.5 * sum(sizes.values()), rel=0.1)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got) == mixing.mix(docs).count()
    assert mixing.mix(docs_of([])).count() == 0


# ---- top-k -----------------------------------------------------------------
@pytest.mark.parametrize("scale_up", [1.0, 3e6])
def test_top_k_equals_brute_force(spark, scale_up, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 60)
    rnd = np.random.default_rng(5)
    v = (rnd.standard_normal((200, 6)) * scale_up).astype(np.float32)
    v[50:120] = v[40]  # very many ties
    rows = [(i, x.tolist(), 1) for i, x in enumerate(v)]
    odd = [(1000, None, 0), (1020, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (1040, [float("nan")] * 6, 0), (None, [1.0] * 6, 0), (2000, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int").repartition(3)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, k=20, every=20).collect()}
    w = np.floor(64 * v.astype(float)).astype(np.int64)
    want = {}
    for q in range(0, 200, 20):
        s = sorted((-int(np.dot(w[q].astype(object), w[c].astype(object))), c) for c in range(200) if c != q)[:20]
        want |= {(q, k + 1): (c, -x) for k, (x, c) in enumerate(s)}
    assert got == want
    few = topk.top_k(spark.createDataFrame(rows[:5], "vec_id long, embedding array<float>, score int")).collect()
    assert len(few) == 4
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- fingerprints ----------------------------------------------------------
def test_top_k_keeps_wide_and_repeated_vectors(spark):
    rnd = random.Random(29)
    wide = lambda e: [float(rnd.choice([-1, 1]) * rnd.randrange(1 << 20)) * 2.0 ** e for _ in range(4)]
    rows = [(i, wide(rnd.choice([-26, -10, 1, 2]))) for i in range(60)]
    rows += [(20, wide(0)), (20, wide(-8)), (41, rows[41][1]), (5, rows[7][1]), (61, [2.0 ** 28, 0.0, 0.0, 0.0]), (62, [])]
    rows += [(80, [1e9, 0.0]), (100, [0.5, 0.0]), (120, [0.25, 0.1]), (140, []), (160, [2.0 ** 57, 0.0, 0.0]), (64, [-1 / 64, 7.0, 0.0]), (65, [0.0, 1.0, 1.0])]
    rows += [(63, [float("inf"), 0.0]), (66, [1e307, 0.0])]  # not finite after scaling
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, k=7, every=20).collect())
    v = [(i, [math.floor(64 * x) for x in e]) for i, e in rows if i not in (63, 66)]
    want = []
    for a, (i, x) in enumerate(v):
        if i % 20 == 0:
            s = sorted((-sum(map(int.__mul__, x, y)), j) for b, (j, y) in enumerate(v) if b != a and len(x) == len(y))[:7]
            want += [(i, k + 1, j, -score) for k, (score, j) in enumerate(s)]
    assert max(abs(w[3]) for w in want) > 1 << 58
    assert got == sorted(want)
    with pytest.raises(Exception, match="does not fit into long"):
        topk.top_k(spark.createDataFrame([(20, [1e300]), (1, [1e300])], "vec_id long, embedding array<double>")).collect()


def test_scores_are_exact_up_to_the_ends_of_long():
    q = np.array([[2.0 ** 62, 2.0 ** 62, 3.0], [-(2.0 ** 63), 0.0, 0.0], [2.0 ** 70, 2.0 ** 70, 5.0]])
    c = np.array([[1.0, 0.0, 1.0], [1.0, -1.0, 2.0]])
    no = np.zeros((3, 2), bool)
    with pytest.raises(OverflowError):
        topk._scores(q, c, no)
    assert topk._scores(q, c, np.array([[0, 0], [0, 0], [1, 0]], bool))[:, 1].tolist() == [6, -(2 ** 63), 10]
    assert topk._scores(q[:2], c, no[:2]).tolist() == [[2 ** 62 + 3, 6], [-(2 ** 63), -(2 ** 63)]]
    assert topk._scores(q[2:], c[1:], no[2:, 1:]).tolist() == [[10]]


def test_edited_fingerprints(docs_of):
    texts = some_texts(50) + ["é" * 7, "", None, "x y z " * 500]
    rows = [(i * 7 - 20, t) for i, t in enumerate(texts)] + [(None, "last of all")]
    got = {r["doc_id"]: r for r in minhash.edited_fingerprints(docs_of(rows), bucket_rows=9).collect()}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]) + rows[-1:]
    assert len(got) == len(rows)
    for (d, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        k = len(t) // 3
        assert got[d]["n_chars"] == len(t)
        assert got[d]["edited_sha256"] == hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest()
        assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
    one = minhash.edited_fingerprints(docs_of([(1, "a b c d e f g"), (1, "a b c d e f g")])).collect()
    assert one[0]["fingerprint"] == one[1]["fingerprint"] and one[0]["near_next"] == 1.0
    assert minhash.edited_fingerprints(docs_of([])).count() == 0


def test_fingerprints_carry_the_class_of_near_copies(docs_of):
    base = [f"w{i}" for i in range(300)]
    copy, other = " ".join(base), " ".join(base[::-1])
    near = " ".join(base[:150] + ["x"] + base[151:])
    rows = [(5, copy), (9, near), (12, copy), (12, copy), (20, other), (21, "one"), (22, "one"), (30, None), (31, ""), (None, copy), (None, near),
            (40, near), (40, "alone here"), (41, "alone here")]
    out = minhash.fingerprints_and_classes(docs_of(rows), bucket_rows=3)
    got = sorted(((r["doc_id"], r["class_id"]) for r in out.collect()), key=str)
    assert got == sorted([(5, 5), (9, 5), (12, 5), (12, 5), (20, 20), (21, 21), (22, 21), (30, 30), (31, 31), (None, None), (None, None),
                          (40, 5), (40, 5), (41, 40)], key=str)
    assert out.columns[-1] == "class_id" and minhash.fingerprints_and_classes(docs_of([])).count() == 0


def test_likeness_estimates_jaccard():
    import pyarrow as pa
    rnd = random.Random(8)
    a = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    for share in (0.0, 0.3, 0.6, 1.0):
        b = a[:int(400 * share)] + [f"v{i}" for i in range(400 - int(400 * share))]
        s = minhash.signatures(pa.array([" ".join(a), " ".join(b)]))
        x, y = ({tuple(t[i:i + 5]) for i in range(396)} for t in (a, b))
        assert minhash.likeness(*s) == pytest.approx(len(x & y) / len(x | y), abs=0.13)


# ---- language ID -----------------------------------------------------------
def test_language_id_on_held_out_texts(docs_of):
    rnd = random.Random(2)
    parts = {"xx": ["ka", "lo", "mi", "zu"], "yy": ["thr", "ing", "ould", "wh"], "zz": ["ção", "ñe", "éu", "ao"]}
    rows = []
    for i in range(240):
        lang = rnd.choice(list(parts))
        rows.append((i, " ".join("".join(rnd.choices(parts[lang], k=rnd.randint(1, 4))) for _ in range(rnd.randint(5, 200))), lang))
    rows += [(1000, None, "xx"), (1001, "", None), (1002, "12 34 !?", "yy"), (1003, "kalomi zu", None), (None, "kalomi zu", "xx")]
    got = langid.predict(docs_of(rows)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    held = [d for d, _, lang in rows if d is not None and d < 1000 and by[d]["held_out"]]
    truth = {d: lang for d, _, lang in rows}
    assert sum(by[d]["lang_pred"] == truth[d] for d in held) >= 0.95 * len(held) > 0
    assert [by[d]["lang_pred"] for d in (1000, 1001, 1002)] == ["und"] * 3
    assert by[None]["held_out"] is False and all(0 <= r["score"] <= 1 for r in got)
    docs = docs_of(rows)
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(by) - {1000, 1001, 1002}
    assert langid.keep_known(docs_of([])).count() == 0
    nothing = langid.predict(docs_of([(1, "abc", None)])).collect()
    assert nothing[0]["lang_pred"] == "und" and nothing[0]["score"] == 0.0


def test_repeated_rows_do_not_swell_the_training_sample(docs_of):
    rows = [(3, "ka lo mi zu " * 9, "xx")] * 300 + [(k, "thr ing ould wh " * 9, "yy") for k in range(10, 30)]
    kept = langid.fit(docs_of(rows))
    assert kept is not None and set(kept.labels) <= {"xx", "yy"}
    assert langid.predict(docs_of(rows)).count() == len(rows)


def test_every_language_is_learned(docs_of, monkeypatch):
    monkeypatch.setattr(langid, "MOST_DOCS", 50)
    monkeypatch.setattr(langid, "EPOCHS", 1)
    # more languages than the sample would have documents, one of them on a third of the rows
    rows = [(i, f"ka lo {i}", "often" if i % 3 == 0 else f"l{i % 300}") for i in range(3000)]
    want = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1}
    sample = langid.sampled(docs_of(rows))
    assert set(sample.column("lang").to_pylist()) == want and len(want) > 190
    assert len(set(sample.column("doc").to_pylist())) == len(want)
    assert set(langid.fit(docs_of(rows)).labels) == want


def test_judge_equals_windows_one_by_one():
    rnd = random.Random(23)
    model = langid.ByteCNN(["a", "b", "c"])
    texts = [bytes(rnd.choices(range(256), k=n)) for n in (0, 1, 3, 4, 255, 256, 257, 700, 20_000)]
    got = model.judge(texts, model.tables())
    for text, row in zip(texts, got):
        total, seen = np.zeros(3), 0
        for at in range(0, max(1, len(text) - 3), 253):  # windows of 256 bytes, the last three bytes shared
            w = text[at:at + 256]
            if not w:
                continue
            padded = np.frombuffer(w.ljust(256, b"\0"), np.uint8)
            e = model.p["embed"][padded].astype(float)
            full = sum(e[k:k + 253] @ model.p["conv"][k] for k in range(4)).max(0)
            logits = np.maximum(full + model.p["bias"], 0) @ model.p["out"] + model.p["out_bias"]
            prob = np.exp(logits) / np.exp(logits).sum()
            total, seen = total + prob * len(w), seen + len(w)
        assert np.allclose(row, total / seen if seen else 0, atol=1e-4)


def test_windows_cover_every_filter_position():
    for n in (1, 3, 4, 255, 256, 257, 509, 510, 5000):
        raw = bytes(i % 251 for i in range(n))
        seen = {raw.find(w[i:i + 4], 0) for w in langid.windows_of(raw) for i in range(len(w) - 3)}
        assert len(seen) >= min(max(0, n - 3), 251) and all(len(w) <= langid.WINDOW for w in langid.windows_of(raw))
    assert langid.windows_of(b"") == []


# ---- licenses --------------------------------------------------------------
def test_automata_accept_optional_and_replaceable_regions():
    a = licenses.Automaton("use <<optional>> of <<optional>> the <<end>> work <<end>> is granted <<any 2>> always")
    for text, n in {"use is granted always": 4, "use of work is granted by us always x": 8, "use of the work is granted always": 7,
                    "use the work is granted always": 0, "use is granted by all of us always": 0, "use is granted": 0}.items():
        assert a.longest(iter(text.split())) == n
    with pytest.raises(ValueError):
        licenses.Automaton("<<optional>> nothing <<end>>")


def test_license_scan_against_search_by_words(docs_of):
    lines = ["Licensed under CC BY-NC 4.0.", "All rights reserved.", "Released under the MIT License.", "CC BY", "all rights all rights reserved",
             "Copyright (c) 2020 Some Person. All rights reserved.", "GNU General Public License, version 3"]
    rnd = random.Random(4)
    rows = [(i, t + "\n" + rnd.choice(lines) + " " + rnd.choice(lines + ["", "Über"])) for i, t in enumerate(some_texts(60))]
    rows += [(100, None), (101, ""), (102, "cc"), (103, "cc by cc by")]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(rows)).collect()}
    for d, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = got[d]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) or not r["base_labels"]
        assert ("mit" in r["labels"].split(",")) == ("MIT License" in (text or ""))
        assert ("cc-by-nc-4.0" in r["labels"].split(",")) == ("CC BY-NC 4.0" in (text or ""))
    assert licenses.scan(docs_of([])).count() == 0


# ---- chat ------------------------------------------------------------------
def test_escaping_is_reversible():
    rnd = random.Random(6)
    for _ in range(2000):
        t = "".join(rnd.choices(["\\", "#", "###", "</turn>", "a", "\n", "é"], k=rnd.randint(0, 12)))
        assert chat.unescape(chat.escape(t)) == t
        assert not re.search(r"(?<!\\)(?:\\\\)*(?:###|</turn>)", chat.escape(t)) or "####" in t


@pytest.mark.skipif(not os.path.exists(chat.VOCABULARY), reason="no vocabulary file")
def test_chat_round_trip(spark):
    odd = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", odd), (1, 2, "assistant", None), (2, 5, None, "x" * 5000), (2, 3, "assistant", "ñ 漢字\n" * 30),
            (2, 3, "assistant", "ñ 漢字\n" * 30), (None, 0, "user", odd), (3, None, "system", "")]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, start int").repartition(3)
    formatted = chat.format_turns(turns)
    starts = sorted((r["turn_no"], r["start"], len(r["input_ids"])) for r in formatted.where("conv_id = 1").collect())
    assert [s for _, s, _ in starts] == list(np.cumsum([0] + [n for *_, n in starts])[:-1])
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: -1 if r[1] is None else r[1])
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(mine)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(turns.limit(0))).count() == 0


# ---- packing ---------------------------------------------------------------
def test_packing_places_every_word_once(docs_of):
    rnd = random.Random(9)
    rows = [(i, "w " * rnd.choice([1, 3, 20, 40, 63, 64, 65, 200])) for i in range(300)] + [(900, None), (901, " "), (902, "w " * 1000), (None, "w"), (5, "w w")]
    got = packing.pack(docs_of(rows), lengths=(16, 32, 64), shard_rows=64).collect()
    want = defaultdict(int)
    for d, t in rows:
        n = len((t or "").split())
        want[d] += n + 1 if n else 0
    have = defaultdict(int)
    bins = defaultdict(list)
    for r in got:
        have[r["doc_id"]] += r["n_tokens"]
        if r["bin_id"] is None:
            assert r["n_tokens"] == 0
        else:
            bins[r["bin_id"], r["bin_capacity"]].append((r["bin_offset"], r["n_tokens"]))
    assert have == want
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), pieces in bins.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity and capacity == min(c for c in (16, 32, 64) if c >= at)
    filled = sum(have.values()) / sum(c for _, c in bins)
    assert filled > 0.9
    assert packing.pack(docs_of([])).count() == 0


def test_texts_are_rebuilt_from_the_bins(docs_of):
    rnd = random.Random(19)
    gap = lambda: rnd.choice([" ", "\n", "  ", "\t\r\n", "\v \f"])
    word = lambda: rnd.choice(["w", "é\u00a0ü", "日本", "\x1f", "x" * 300])
    text = lambda n: gap() + "".join(word() + gap() for _ in range(n)) + rnd.choice(["", "end"])
    rows = [(i, text(rnd.choice([1, 15, 16, 31, 32, 33, 63, 64, 65, 200]))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "w " * 64), (204, "w " * 63 + "w"), (205, text(5000)), (206, "z" * 2_000_000)]
    packed = packing.pack(docs_of(rows), lengths=(16, 32, 64), shard_rows=64)
    found = defaultdict(dict)
    for b in packing.sequences(packed).collect():
        assert b["n_tokens"] <= b["bin_capacity"]
        at = 0
        for p in b["parts"]:
            assert p["bin_offset"] == at and p["piece"] not in found[p["doc_id"]]
            last = p["n_tokens"] == len(packing.WORD.findall(p["text"])) + 1  # with the end mark
            found[p["doc_id"]][p["piece"]] = (p["text"], last)
            at += p["n_tokens"]
        assert at == b["n_tokens"]
    for d, t in rows:
        if t is None or not packing.WORD.search(t):
            assert d not in found
            continue
        pieces = [found[d][k] for k in range(len(found[d]))]
        assert "".join(x for x, _ in pieces) == t
        assert [last for _, last in pieces] == [False] * (len(pieces) - 1) + [True]
    unplaced = {r["doc_id"]: r["text"] for r in packed.where("bin_id IS NULL").collect()}
    assert unplaced == {200: None, 201: "", 202: " \n "}


def test_packing_goes_on_beyond_the_bytes_a_task_holds(docs_of, monkeypatch):
    monkeypatch.setattr(packing, "MOST_BYTES", 100)
    got = packing.pack(docs_of([(i, "w " * (i % 9)) for i in range(200)]), lengths=(8, 16), shard_rows=300).collect()
    used = defaultdict(int)
    for r in got:
        if r["bin_id"] is not None:
            used[r["bin_id"], r["bin_capacity"]] += r["n_tokens"]
    assert len({b for b, _ in used}) == len(used) and all(n <= c for (_, c), n in used.items())
    assert sum(used.values()) == sum(i % 9 + (i % 9 > 0) for i in range(200))


def test_packing_of_one_doc_id_in_all_rows(docs_of):
    got = packing.pack(docs_of([(7, "w w w")] * 200 + [(7, None)] * 50), lengths=(8, 16), shard_rows=4).collect()
    assert sum(r["n_tokens"] for r in got) == 800 and sum(r["bin_id"] is None for r in got) == 50
    used = defaultdict(list)
    for r in got:
        if r["bin_id"] is not None:
            used[r["bin_id"], r["bin_capacity"]].append((r["bin_offset"], r["n_tokens"]))
    assert len({b for b, _ in used}) == len(used)
    for (_, capacity), pieces in used.items():
        assert sorted(o for o, _ in pieces) == list(range(0, 4 * len(pieces), 4)) and 4 * len(pieces) <= capacity


def test_best_fit_equals_a_plain_search():
    rnd = np.random.default_rng(1)
    sizes = -np.sort(-rnd.integers(1, 65, 200))
    which, offset, _ = packing.best_fit(sizes, (16, 32, 64))
    room, opened = {}, {}
    for i, (s, b) in enumerate(zip(sizes.tolist(), which.tolist())):
        fits = [r for r in room.values() if r >= s]
        if b in room:
            assert room[b] == min(fits) and offset[i] == opened[b] - room[b]
        else:
            assert not fits
            total = next(c for c in (16, 32, 64) if c >= s) if s > 32 else None
            left = np.bincount(sizes[i:], minlength=65)
            opened[b] = room[b] = packing._least_cost(s, left, sorted(set(sizes[i:].tolist())), (16, 32, 64))
            assert total is None or room[b] == total
        room[b] -= s


# ---- URLs ------------------------------------------------------------------
def rule_of(url, rules):
    """(host, path, rule) by plain string search."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: s[:min([s.index(m) for m in marks if m in s], default=len(s))]
    host = cut(rest, "/?#")
    path = cut(rest[len(host):], "?#")
    host = host.translate(LOWER)
    fits = [r for _, r in rules for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, max(fits, key=len, default=None)


def test_url_rules_and_trees(spark):
    rnd = random.Random(7)
    urls = [None, "", "no scheme", "http://", "http://COM", "http://com/", "https://example.com/en/1", "https://www.example.com/en/", "x://a.net/es/?q#f",
            "http://a.net/fr", "http://notexample.com/en/", "http://user@Example.COM:80/en/", "http://a.b://c/d", "http://h?x=/en/", "http://é.org/#"]
    urls += [f"https://{rnd.choice(['a', 'b.c', 'www.example'])}.{rnd.choice(['com', 'net', 'org'])}/{rnd.choice(['en', 'fr', 'es'])}/{i}" for i in range(150)]
    pages = spark.createDataFrame([(i, u, "<p>", "clash") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    action = {r: a for a, r in urlfilter.RULES}
    for r in urlfilter.judge(pages).collect():
        host, path, rule = rule_of(urls[r["page_id"]], urlfilter.RULES)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == action[rule] if rule else r["verdict"] in ("allow", "block")
    none = urlfilter.judge(pages.limit(3)).collect()
    assert {r["verdict"] for r in none} == {"allow"}
    assert urlfilter.judge(pages.limit(0)).count() == 0


def test_url_trees_learn_from_labels(spark):
    bad = [f"http://win-{i}-cash.example.org/{i}{i}?a={i}&b={i}&c=1" for i in range(120)]
    good = [f"https://news.example.org/story/page{i % 7}" for i in range(120)]
    labelled = spark.createDataFrame([(u, 1.0) for u in bad[:80]] + [(u, 0.0) for u in good[:80]], "url string, label double")
    pages = spark.createDataFrame(list(enumerate(bad[80:] + good[80:])), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urlfilter.judge(pages, labelled, rules=()).collect()}
    assert sum(got[i] == ("block" if i < 40 else "allow") for i in got) >= 0.95 * len(got)


# ---- WARC ------------------------------------------------------------------
def test_warc_round_trip(spark):
    rnd = random.Random(3)
    html = ["<p>é" + "".join(rnd.choices("abcdef <>/", k=rnd.randint(0, 3000))) for _ in range(60)]
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(html + html[:20])] + [(100, None, None), (101, "u\r\nX: y", ""), (None, "z", html[5]), (7, "http://h/7", html[7])]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    folder = new_folder(spark, "warc")
    manifest = warc.write(pages, folder)
    same = defaultdict(list)
    for i, _, h in rows:
        same[h or ""].append(i)
    want = []
    for h, ids in same.items():
        last = max(i for i in ids if i is not None)
        raw = h.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want += [(i, len(raw), digest, *(("response", None) if i == last else ("revisit", last))) for i in ids]
    for step in (300, 5000, 1 << 24):
        got = [tuple(r) for r in warc.read(spark, folder, manifest, step).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0
    small = {r["record_type"] for r in warc.round_trip(pages.where("length(html) < 1000"), min_bytes=10**6).collect()}
    assert small <= {"response"}


def test_damaged_archives_are_reported(spark):
    rnd = random.Random(37)
    pages = spark.createDataFrame([(i, f"http://h/{i}", "".join(rnd.choices("abcdefgh", k=rnd.randint(500, 90_000)))) for i in range(40)],
                                  "page_id long, url string, html string").repartition(1)
    folder = new_folder(spark, "warc")
    manifest = warc.write(pages, folder)
    assert warc.missing(manifest, warc.read(spark, folder, manifest)).count() == 0
    name = manifest.first()["path"]
    fs, root = warc._filesystem(folder)
    with fs.open_input_file(f"{root}/{name}") as f:
        whole = f.read()
    starts = [at for at, _ in warc.members(io.BytesIO(whole), 0, len(whole))]
    assert len(starts) == 40

    def reread(data, step=20_000):
        with fs.open_output_stream(f"{root}/{name}", compression=None) as f:
            f.write(data)
        found = warc.read(spark, folder, manifest, step)
        rows = found.collect()
        bad = [r["offset"] for r in rows if r["record_type"] == "damaged"]
        return len(rows) - len(bad), bad, [tuple(r) for r in warc.missing(manifest, found).collect()]

    assert reread(whole) == (40, [], [])
    cut = (starts[20] + starts[21]) // 2
    assert reread(whole[:cut]) == (20, [starts[20]], [(name, 40, 20)])
    flipped = bytearray(whole)
    flipped[starts[11] - 6] ^= 4  # a checksum's bit
    flipped[(starts[30] + starts[31]) // 2] ^= 64
    flipped[starts[5]] ^= 1  # no gzip magic any more
    assert reread(bytes(flipped)) == (37, [starts[10], starts[30]], [(name, 40, 37)])
    fs.delete_file(f"{root}/{name}")
    gone = warc.read(spark, folder, manifest)
    assert gone.count() == 0 and [tuple(r) for r in warc.missing(manifest, gone).collect()] == [(name, 40, 0)]


def test_reader_skips_magic_inside_members_and_owns_by_start():
    rnd = random.Random(1)
    payloads = [rnd.randbytes(rnd.randint(0, 400)) + warc.MAGIC * 3 + rnd.randbytes(50) for _ in range(40)]
    members = [warc._member(warc._record(i, "u", p, "D", False, None)) for i, p in enumerate(payloads)]
    data = b"garbage" + warc.MAGIC + b"".join(members)
    for step in (1, 37, 1000, len(data)):
        got = [warc._parsed(r) for s in range(0, len(data), step) for r in warc.records(io.BytesIO(data), s, s + step)]
        assert [(g[0], g[2]) for g in got] == list(enumerate(payloads))


def test_a_url_of_its_own_segment_does_not_give_its_label_away(spark):
    """Every URL has a first segment of its own; the depth tells the label in 85 of 100."""
    rnd = random.Random(4)

    def some(n, tag):
        rows = []
        for i in range(n):
            bad = i % 2
            deep = bad if rnd.random() < 0.85 else 1 - bad
            rows.append((f"http://h{i % 9}.example.org/{tag}{i}" + "/a/b/c" * deep, float(bad)))
        return rows

    known, new = some(1500, "k"), some(400, "n")
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(new)], "page_id long, url string")
    labelled = spark.createDataFrame(known, "url string, label double")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages, labelled, rules=()).collect()}
    assert sum((got[i] == "block") == bool(b) for i, (_, b) in enumerate(new)) >= 0.8 * len(new)


def test_url_counts_over_several_partitions_and_repeated_pages(spark):
    rows = [(7, "http://a.com/x/1"), (7, "http://a.com/x/1"), (7, "http://b.net/y"), (None, "http://b.net/es/z"), (8, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    got = sorted(map(str, urlfilter.judge(pages).select("page_id", "host", "rule", "verdict").collect()))
    assert len(got) == 5 and sum("host='a.com'" in r and "verdict='allow'" in r for r in got) == 2
    known = spark.createDataFrame([("http://a.com/x/1", 1.0), ("http://a.com/x/2", 0.0), ("http://b.com/y", 1.0)], "url string, label double")
    counts = {(r.kind, r.value): (r.n, r.blocked, sum(r.fold_n), sum(r.fold_blocked)) for r in urlfilter.end_counts(known).collect()}
    assert counts == {("suffix", "com"): (3, 2.0, 3, 2.0), ("lead", "x"): (2, 1.0, 2, 1.0), ("lead", "y"): (1, 1.0, 1, 1.0)}
