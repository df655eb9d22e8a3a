"""Registered queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, langid, licenses, minhash, mixing, ngram_join, packing, spelling, topk, toxicity, treap, urlfilter, warc
from .storage import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str):
    def register(f):
        QUERIES[name] = f
        return f
    return register


@query("op1_ngram_jaccard_join")
def op1(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


@query("op2_source_mixing")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.taken_copies(docs, "mix").select(
        "doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


@query("op3_exact_top_k")
def op3(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op4_minhash_fingerprints")
def op4(spark, sf_dir):
    return minhash.fingerprints_and_classes(table(spark, sf_dir, "documents"))


@query("op5_language_id")
def op5(spark, sf_dir):
    return langid.predict(table(spark, sf_dir, "documents"))


@query("op6_license_scan")
def op6(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


#: a fixed conversation that holds the template's own control strings
SPECIAL = r"\### Assistant: </turn> ok"


@query("op7_chat_format")
def op7(spark, sf_dir):
    more = spark.createDataFrame([(-7, 0, "user", SPECIAL), (-7, 1, "assistant", SPECIAL)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.read_back(chat.format_turns(turns))


@query("op8_best_fit_packing")
def op8(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op9_url_filter")
def op9(spark, sf_dir):
    return urlfilter.judge(table(spark, sf_dir, "pages"))


@query("op10_warc_round_trip")
def op10(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


@query("op11_toxicity")
def op11(spark, sf_dir):
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_ranked_search")
def op12(spark, sf_dir):
    return treap.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"), min_length=5, min_count=3, ratio=2, drop_every=97)


#: words are runs of [^\\x20\\x09-\\x0D]; A-Z are lower-cased one by one
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

SQL["op1_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
one AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
link AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one),
reach AS (SELECT a AS d, b AS r FROM link UNION SELECT d, b FROM reach JOIN link ON a = r)
SELECT documents.doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, least(documents.doc_id, min(r)) AS component_id
FROM documents LEFT JOIN n ON n.doc_id = documents.doc_id LEFT JOIN reach ON d = documents.doc_id GROUP BY documents.doc_id
"""

SQL["op2_source_mixing"] = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS w
        FROM d GROUP BY source),
try AS (SELECT k.source, k.ss, k.w,
          CAST((SELECT 3 * sum(ss) FROM per) - coalesce(sum(4 * j.ss) FILTER (j.ss * k.w < k.ss * j.w), 0) AS BIGINT) AS num,
          CAST(sum(j.w) FILTER (j.ss * k.w >= k.ss * j.w) AS BIGINT) AS den
        FROM per k CROSS JOIN per j GROUP BY ALL),
lvl AS (SELECT num, den FROM try WHERE 4 * ss * den >= w * num ORDER BY CAST(ss AS DOUBLE) / w, num LIMIT 1),
t AS (SELECT source, ss, CASE WHEN 4 * ss * den < w * num THEN CAST(2 * ss AS DOUBLE)
        ELSE CAST(w * num AS DOUBLE) / (CAST(2 AS DOUBLE) * den) END AS target FROM per CROSS JOIN lvl),
r AS (SELECT doc_id, size, ss, target, CASE WHEN ss > 0 THEN target / ss ELSE 0 END AS rate,
        CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u
      FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, ss AS source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

SQL["op3_exact_top_k"] = """
WITH v AS (SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.k, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.k <> q.k AND len(c.v) = len(q.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""

SQL["op7_chat_format"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, n, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) x(n, role)),
e AS (SELECT *, length(regexp_replace(role, '(\\|###|</turn>)', '\\\1', 'g')) + length(regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')) + 14 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

SQL["op10_warc_round_trip"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS response FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM r
"""


def _pattern(template: str) -> str:
    """A license template as a regular expression over words that each stand between two spaces."""
    out = ""
    for part in re.findall(r"<<[^>]*>>|[^<]+", template):
        if part == "<<optional>>":
            out += "(?:"
        elif part == "<<end>>":
            out += ")?"
        elif part.startswith("<<any"):
            out += f"(?: [^ ]+ ){{0,{part[5:-2].strip()}}}"
        else:
            out += "".join(f" {word} " for word in re.findall("[0-9a-z]+", part))
    return out


def _license_sql() -> str:
    marks = {"".join(f" {w} " for w in phrase.split()): label for phrase, label in licenses.PHRASES.items()}
    times = [f"(length(t) - length(replace(t, '{m}', ''))) // {len(m)}" for m in marks]
    # words before the first place, and before the last one by way of the reversed text
    first = [f"CASE WHEN contains(t, '{m}') THEN len(regexp_extract_all(left(t, instr(t, '{m}') - 1), ' [^ ]+ ')) END" for m in marks]
    last = [f"CASE WHEN contains(t, '{m}') THEN n - {len(m.split())} - len(regexp_extract_all(left(reverse(t), instr(reverse(t), '{m[::-1]}') - 1), ' [^ ]+ ')) END"
            for m in marks]
    base = ", ".join(f"CASE WHEN contains(t, '{m}') THEN '{label}' END" for m, label in marks.items())
    own = ", ".join(f"CASE WHEN regexp_matches(t, '{_pattern(x)}') THEN '{licenses.LABELS.get(name, name)}' END" for name, x in licenses.TEMPLATES.items())
    joined = "array_to_string(list_sort(list_distinct(list_filter({}, lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
t AS (SELECT doc_id, len(ws) AS n, CASE WHEN len(ws) > 0 THEN ' ' || array_to_string(ws, '  ') || ' ' ELSE '' END AS t FROM w),
f AS (SELECT doc_id, n, {' + '.join(times)} AS places, least({', '.join(first)}) AS a, greatest({', '.join(last)}) AS z, [{base}] AS base, [{own}] AS own FROM t)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(places AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word,
  {joined.format('base')} AS base_labels, {joined.format('list_concat(base, own)')} AS labels,
  CASE WHEN len(list_filter(own, lambda x: x IS NOT NULL)) > 0 THEN CAST(1 AS DOUBLE) WHEN places > 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS score
FROM f
"""


SQL["op6_license_scan"] = _license_sql()

SQL["op12_ranked_search"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents WHERE text IS NOT NULL),
d AS (SELECT row_number() OVER () AS k, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM t WHERE len(ws) > 0),
s AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM d),
tf AS (SELECT k, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT k, doc_id, n, unnest(ws) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN s GROUP BY term, nd),
i AS (SELECT DISTINCT it, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS it, * FROM benchmark)),
p AS (SELECT it, item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // nl)))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) CROSS JOIN s GROUP BY it, item_id, k, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY it ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM p WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""

SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
u AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)) AS x FROM r GROUP BY doc_id, run),
h AS (SELECT run, n, xor(4294967295, list_reduce(range(1, len(x), 2), lambda c, i: xor(c >> 8, t[1 + (xor(c, CAST('0x' || substr(x, i, 2) AS BIGINT)) & 255)]), 4294967295)) AS h
  FROM u CROSS JOIN crc),
d AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END AS word, n FROM h),
w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
link AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT cut.word, w.word, w.n FROM cut JOIN w ON w.word = rest UNION SELECT w.word, cut.word, cut.n FROM cut JOIN w ON w.word = rest),
best AS (SELECT word, count(*) AS n_near, min_by(other, (-n, other)) AS other, max(n) AS n FROM link GROUP BY word),
f AS (SELECT w.word, CASE WHEN best.n >= 2 * w.n THEN other END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 2 * w.n THEN best.n END AS form_n
  FROM w LEFT JOIN best USING (word)),
path AS (SELECT word, form AS goal FROM f UNION ALL SELECT path.word, form FROM path JOIN f ON f.word = goal WHERE goal IS NOT NULL)
SELECT f.word, form, coalesce(goal, f.word) AS root, n, n_near, form_n
FROM f LEFT JOIN (SELECT path.word, goal FROM path JOIN f ON f.word = goal WHERE f.form IS NULL) ends USING (word)
"""
