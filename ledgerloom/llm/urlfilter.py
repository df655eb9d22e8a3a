"""URL verdicts from host and path rules, and from gradient-boosted trees where no rule fits.

Rules are ``action host/path``.  A rule fits its host and all subdomains, if the URL's path
starts with the rule's path; of several, the longest wins.  The other URLs are judged by
boosted trees on lexical features: lengths, depth, digit ratio, entropy, parameter counts,
hyphens, labels, and statistics of the host's suffixes in all labelled URLs (smoothed share
of blocked ones by last label and by first path segment; a repeated URL counts once).  A training
row's shares are those of the other folds, so that its own label does not speak for it.  Only
the trees' training takes a bounded sample of them (``train_rows``, smallest hashes first).
Without an URL of either kind the more frequent label, or else allow, is the answer.

Features, rules and the trees run as DataFrame and ``pyspark.ml`` operations only.

Host and path of a null URL, or of one without ``://``, are empty; it is judged by the trees
like any other.  Repeated rows are judged alike; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .storage import saved

#: fixed values: the rules of the registered query
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

TRAIN_ROWS = 20_000
TREES, DEPTH = 8, 4
ENDS = ("suffix", "lead")
FOLDS = 5
FEW = 100_000  # suffixes and leads that are broadcast: some megabytes
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host`` and ``path``."""
    text = F.coalesce(F.col(url), F.lit(""))
    return urls.withColumn("host", F.translate(F.regexp_extract(text, _PARTS, 1), UPPER, LOWER)).withColumn(
        "path", F.regexp_extract(text, _PARTS, 2))


def rule_column(rules: tuple[tuple[str, str], ...]) -> Column:
    """The rule that decides on (host, path), longest first, or null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        host, _, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}")
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def features(urls: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """The lexical features of (url, host, path), in columns f_*."""
    url = F.coalesce(F.col("url"), F.lit(""))
    length = F.length(url)
    letters = F.filter(F.split(url, ""), lambda c: c != "")
    share = lambda c: (length - F.length(F.replace(url, c, F.lit("")))) / length
    entropy = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))
    count = lambda col, pattern: F.regexp_count(col, F.lit(pattern)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    host, path = F.col("host"), F.col("path")
    found = {
        "f_length": length.cast("double"), "f_host_length": F.length(host).cast("double"), "f_path_length": F.length(path).cast("double"),
        "f_depth": count(path, "/[^/]+"), "f_labels": count(host, "[^.]+"), "f_hyphens": count(host, "-"),
        "f_digits": F.when(length > 0, count(url, "[0-9]") / length).otherwise(0.0),
        "f_host_digits": count(host, "[0-9]"), "f_entropy": F.when(length > 0, entropy).otherwise(0.0),
        "f_params": count(query, "[^&]+"), "f_fragment": F.contains(url, F.lit("#")).cast("double"),
        "f_https": url.startswith("https:").cast("double"),
    }
    return with_ends(urls.withColumns(found))


def with_ends(urls: DataFrame) -> DataFrame:
    """``urls`` with the host's last label and the path's first segment."""
    return urls.withColumns({"suffix": F.substring_index("host", ".", -1), "lead": F.regexp_extract("path", "^/([^/]*)", 1)})


def end_counts(known: DataFrame) -> DataFrame:
    """(kind, value, n, blocked, fold_n, fold_blocked): labelled URLs by suffix and by lead, in all and in each fold."""
    ends = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ENDS]))
    rows = with_ends(with_parts(known)).select("label", _fold().alias("fold"), ends.alias("end")).select("label", "fold", "end.*")
    each = lambda f: F.array(*[f(F.when(F.col("fold") == k, F.col("label"))) for k in range(FOLDS)])
    return rows.groupBy("kind", "value").agg(
        F.count("label").alias("n"), F.sum("label").alias("blocked"), each(F.count).alias("fold_n"),
        each(lambda c: F.coalesce(F.sum(c), F.lit(0.0))).alias("fold_blocked"))


def _fold() -> Column:
    return F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")


def with_shares(urls: DataFrame, counts: DataFrame, few: bool, out_of_fold: bool = False) -> DataFrame:
    """``urls`` with f_suffix and f_lead, the smoothed shares of blocked URLs.

    out_of_fold: over the other folds only, so that a training row's own label is no part of its features.
    few: ``counts`` are known to be few and are broadcast; else they are joined, skewed keys as the session splits them.
    """
    for kind in ENDS:
        share = counts.where(F.col("kind") == kind).select(F.col("value").alias(kind), "n", "blocked", "fold_n", "fold_blocked")
        urls = urls.join(F.broadcast(share) if few else share, kind, "left")
        less = (lambda c: F.get(f"fold_{c}", _fold())) if out_of_fold else (lambda c: F.lit(0))
        n, blocked = (F.coalesce(F.col(c) - less(c), F.lit(0)) for c in ("n", "blocked"))
        urls = urls.withColumn(f"f_{kind}", (blocked + 1.0) / (n + 2.0)).drop("n", "blocked", "fold_n", "fold_blocked")
    return urls


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[tuple[str, str], ...] = RULES,
          train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages``.

    ``labelled`` (url, label; 1 is block) is by default the URLs of ``pages`` that a rule decides.
    """
    action = F.create_map(*(F.lit(x) for a, r in rules for x in (r, a))) if rules else F.lit(None).cast("map<string,string>")
    parts = with_parts(pages.select("page_id", "url"))
    ruled = parts.withColumn("rule", rule_column(rules))
    if labelled is None:
        labelled = ruled.where("rule IS NOT NULL").select("url", (action[F.col("rule")] == "block").cast("double").alias("label"))
    known = saved(labelled.select("url", F.col("label").cast("double").alias("label")).where("label IS NOT NULL")
                  .groupBy("url").agg(F.max("label").alias("label")))
    total = lambda df: df.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    train = known.orderBy(F.md5(F.coalesce("url", F.lit(""))), "url").limit(train_rows)
    train = saved(features(with_parts(train)).coalesce(1))  # at most train_rows short rows: many small steps follow
    n, blocked = total(train)
    rows = features(ruled)
    if 0 < blocked < n:
        counts = saved(end_counts(known))  # of all labelled URLs
        few = counts.limit(FEW + 1).count() <= FEW
        names = [c for c in train.columns if c.startswith("f_")] + [f"f_{kind}" for kind in ENDS]
        vectors = VectorAssembler(inputCols=names, outputCol="features").transform
        fitted = saved(vectors(with_shares(train, counts, few, out_of_fold=True)).select("features", "label").coalesce(1))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7, cacheNodeIds=False).fit(fitted)
        rows = model.transform(vectors(with_shares(rows, counts, few))).withColumn("score", vector_to_array("probability")[1])
    else:
        n, blocked = total(known)
        rows = rows.withColumn("score", F.lit(float(2 * blocked > n)))
    verdict = F.coalesce(action[F.col("rule")], F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
