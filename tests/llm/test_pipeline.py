import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
from ledgerloom.llm import packing

LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def corpus():
    rnd = random.Random(12)
    xx, yy = ["ka", "lo", "mi", "zu"], ["thr", "ing", "ould", "wh"]
    rows = []
    for i in range(120):
        lang = rnd.choice(["xx", "yy"])
        word = lambda: "".join(rnd.choices(xx if lang == "xx" else yy, k=rnd.randint(1, 5)))  # noqa: E731,B023
        rows.append((i, " ".join(word() for _ in range(rnd.randint(3, 90))), lang, rnd.choice(["a", "a", "b", "c", None]), 0))
    for i in range(120, 160):  # exact and near copies
        w = rnd.choice(rows)[1].split()
        for _ in range(rnd.choice([0, 1, 2])):
            w[rnd.randrange(len(w))] = "zuzu"
        rows.append((i, " ".join(w).upper() if i % 3 else " ".join(w), "xx", "b", 0))
    return rows + [(900, None, "xx", "a", 0), (901, "12 34", None, "a", 0), (902, "", "yy", None, 0), (None, "kalo mizu lolo", None, "c", 0)]


def components(rows):
    sets, root = [], list(range(len(rows)))
    for _, text, *_ in rows:
        w = WORDS.findall(text.translate(LOWER))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)})
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    return root


def test_stages_against_brute_force(spark, tmp_path):
    rows = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 3:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[k] = docs.collect()
    # language: only what has no letter goes
    assert {r["doc_id"] for r in kept[0]} == {r[0] for r in rows} - {900, 901, 902}
    # near copies: the smallest doc_id of each component stays
    left = [r for r in rows if r[0] not in (900, 901, 902)]
    smallest = {}
    for r, c in zip(left, components(left)):
        smallest[c] = min(smallest.get(c, r[0]), r[0]) if r[0] is not None else smallest.get(c)
    assert {r["doc_id"] for r in kept[1]} == set(smallest.values())
    assert len(kept[1]) == len(smallest)
    # mixing: whole copies by rate, one more by the draw
    size = {r["doc_id"]: len(WORDS.findall(r["text"])) for r in kept[1]}
    per = Counter()
    for r in kept[1]:
        per[r["source"]] += size[r["doc_id"]]
    names = sorted(s for s in per if s is not None) + [None] * (None in per)
    target, free, pool = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(per.values())
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    while pool > 1e-9:
        share, pool, total = pool, 0.0, sum(weight[s] for s in free)
        for s in sorted(free, key=str):
            target[s] += share * weight[s] / total
            if target[s] > 2 * per[s]:
                pool, target[s] = pool + target[s] - 2 * per[s], 2 * per[s]
                free.discard(s)
    times = Counter(r["doc_id"] for r in kept[2])
    for r in kept[1]:
        rate = target[r["source"]] / per[r["source"]]
        draw = int(hashlib.md5(f"mix-1:{'null' if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:8], 16) / 2 ** 32
        assert times[r["doc_id"]] == int(rate + 1e-9) + (draw < rate - int(rate + 1e-9))
    # packing: every word and end mark once, bins within their capacity
    want = Counter()
    for r in kept[2]:
        want[r["doc_id"]] += len(WORDS.findall(r["text"])) + 1
    have, filled = Counter(), defaultdict(int)
    for r in kept[3]:
        have[r["doc_id"]] += r["n_tokens"]
        filled[r["bin_id"], r["bin_capacity"]] += r["n_tokens"]
    assert have == want
    texts, pieces = {r["doc_id"]: r["text"] for r in kept[2]}, {(r["doc_id"], r["piece"]): r["text"] for r in kept[3]}
    assert {d: "".join(pieces[k] for k in sorted(pieces, key=str) if k[0] == d) for d in texts} == texts
    assert all(n <= c and c == min(x for x in packing.LENGTHS if x >= n) for (_, c), n in filled.items())


def test_run_and_empty_table(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(corpus(), schema).write.parquet(f"{tmp_path}/some/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
