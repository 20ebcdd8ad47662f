"""Quality rules: base counts, then robust multivariate outliers per language and source.

Each document gives a vector of transformed statistics.  For every (language,
source) the minimum covariance determinant is estimated by concentration steps
(from a median/MAD start: take the ``ALPHA`` share of rows with the smallest
distance, re-estimate mean and covariance, repeat), and documents whose squared
Mahalanobis distance passes ``CUTOFF`` are rejected.  DataFrame functions only;
a row's text never leaves its scan, only its numbers are shuffled.

Order statistics are read from counts in fixed fine bins, so that they merge like
sums and do not depend on how rows are dealt out.  A (language, source) with fewer
than ``MIN_ROWS`` rows that pass the base rules uses its language's estimate, and a
language with fewer that of all rows, however few they are; so every row gets a
distance as soon as one row passes the base rules.

Defined cases: NULL or empty text has no words and fails the base rules; NULL
language or source counts as the empty string; repeated rows count and are returned
as often as they occur; an empty table gives no rows; columns other than doc_id,
text, lang and source are ignored.  Windows of eight words are compared by 64-bit hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamkit.llm.shared import let, stage

ALPHA, STEPS, MIN_ROWS = 0.75, 4, 200
SPACE, SYMBOLS, WINDOW = r"[\x20\x09-\x0D]+", "[^#*$%&|<>]+", 8
#: The vector: name, and a scale in its units below which a difference does not count (added to the covariance).
VECTOR = {"log_words": 0.5, "log_word_chars": 0.1, "symbol_share": 0.02, "capital_share": 0.03, "distinct_share": 0.1}
X = list(VECTOR)
#: Parts of a unit in the bins of the first estimate, and of a doubling in those of squared distances.
UNIT, OCTAVE = 500, 64
#: The group of all rows; the other groups are JSON objects.
EVERYTHING = "*"


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower gamma function of (k/2, x/2), by its series."""
    a, y = k / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= y / n
        total += term
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


CUTOFF = chi2_quantile(0.999, len(X))
#: Makes the covariance of the inner ``ALPHA`` share consistent for normal rows.
CONSISTENCY = ALPHA / chi2_cdf(chi2_quantile(ALPHA, len(X)), len(X) + 2)


def repeated_words(words: Column) -> Column:
    """Words covered by windows of eight words that occur twice or more in ``words``."""
    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def flagged(rows: Column) -> Column:
            same = F.transform(rows, lambda r, k: F.when((F.get(rows, k - 1)["h"] == r["h"]) | (F.get(rows, k + 1)["h"] == r["h"]), r["i"]))
            return F.sort_array(F.filter(same, lambda i: i.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-WINDOW).alias("last"))
        step = lambda acc, i: F.struct((acc["words"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("words"), i.alias("last"))
        total = F.aggregate(let(ordered, flagged), start, step, lambda acc: acc["words"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(total)
    windows = lambda h: F.when(F.size(h) >= WINDOW, F.transform(F.sequence(F.lit(1), F.size(h) - WINDOW + 1), lambda i: F.xxhash64(F.slice(h, i, F.lit(WINDOW))))).otherwise(F.array().cast("array<bigint>"))
    return let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), covered)


def measured(docs: DataFrame) -> DataFrame:
    """The base counts and the vector of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), text.alias("text"),
                        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_replace(x, SPACE, "") != "")
    got = words.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).alias("capitals"),
        F.size(F.array_distinct("words")).alias("distinct"))
    chars, n = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    return got.select(
        *got.columns[:8], ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        F.log(n).alias("log_words"), F.log(chars / n).alias("log_word_chars"), (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("capitals") / chars).alias("capital_share"), (F.col("distinct") / n).alias("distinct_share"))


def _quantiles(rows: DataFrame, values: dict[str, Column], q: float, unit: float) -> DataFrame:
    """Per group ``g``: the bin edge below which a share ``q`` of each value lies."""
    long = rows.select("g", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor(v * unit).alias("bin")) for k, v in values.items()])).alias("v")).select("g", "v.k", "v.bin")
    by = Window.partitionBy("g", "k")
    counts = long.groupBy("g", "k", "bin").count().select("g", "k", "bin", F.sum("count").over(by.orderBy("bin")).alias("upto"), F.sum("count").over(by).alias("of"))
    return counts.where(F.col("upto") >= q * F.col("of")).groupBy("g").agg(*[F.min(F.when(F.col("k") == k, (F.col("bin") + 1) / unit)).alias(k) for k in values])


def _estimate(inner: DataFrame) -> DataFrame:
    """Mean ``m_*`` and lower Cholesky factor ``l_*`` of each group's covariance."""
    d = range(len(X))
    fit = inner.groupBy("g").agg(*[F.avg(x).alias(f"m_{x}") for x in X], *[F.covar_pop(X[i], X[j]).alias(f"c_{i}{j}") for i in d for j in range(i + 1)])
    for i in d:
        for j in range(i + 1):
            rest = sum((F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j)), F.lit(0.0))
            c = CONSISTENCY * F.col(f"c_{i}{j}") + (F.lit(VECTOR[X[i]] ** 2) if i == j else F.lit(0.0)) - rest
            fit = fit.withColumn(f"l_{i}{j}", F.sqrt(F.greatest(c, F.lit(VECTOR[X[i]] ** 2 * 1e-3))) if i == j else c / F.col(f"l_{j}{j}"))
    return fit.select("g", *[f"m_{x}" for x in X], *[f"l_{i}{j}" for i in d for j in range(i + 1)])


def _distance(rows: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2`` by forward substitution."""
    for i, x in enumerate(X):
        rest = sum((F.col(f"l_{i}{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y_{i}", (F.col(x) - F.col(f"m_{x}") - rest) / F.col(f"l_{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y_{i}") ** 2 for i in range(len(X))), F.lit(0.0)))


def _inner(dist: DataFrame) -> DataFrame:
    """Per group the squared distance below which a share ``ALPHA`` of its rows lies."""
    octave = {"within": F.log2(F.greatest("d2", F.lit(1e-6)))}
    return _quantiles(dist, octave, ALPHA, OCTAVE).select("g", F.pow(F.lit(2.0), "within").alias("within"))


def fit(rows: DataFrame) -> DataFrame:
    """MCD estimate of every group ``g`` of ``rows`` (columns g and the vector).

    ``rows`` must be a written table: each step reads it twice.  The tables written in
    between hold one row a group; Spark broadcasts them while they are small.
    """
    med = stage(_quantiles(rows, {x: F.col(x) for x in X}, 0.5, UNIT), "median").select("g", *[F.col(x).alias(f"m_{x}") for x in X])
    dev = _quantiles(rows.join(med, "g"), {x: F.abs(F.col(x) - F.col(f"m_{x}")) for x in X}, 0.5, UNIT)
    scale = [(F.col(x) * 1.4826 + F.lit(VECTOR[x])).alias(f"l_{i}{i}") for i, x in enumerate(X)]
    zero = [F.lit(0.0).alias(f"l_{i}{j}") for i in range(len(X)) for j in range(i)]
    now = stage(med.join(dev.select("g", *scale, *zero), "g"), "start")
    for k in range(STEPS):
        within = stage(now.join(_inner(_distance(rows.join(now, "g"))), "g"), f"within-{k}")
        now = stage(_estimate(_distance(rows.join(within, "g")).where("d2 <= within")), f"mcd-{k}")
    return now


def rules(docs: DataFrame) -> DataFrame:
    """Base counts, base_failed, d2 (NULL if no row passes the base rules) and kept, for every row."""
    rows = stage(measured(docs), "measured")
    own, pooled = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    grouped = stage(rows.where("not base_failed").select(F.explode(F.array(own, pooled, F.lit(EVERYTHING))).alias("g"), *X), "vectors")
    sizes = grouped.groupBy("g").agg(F.count("*").alias("rows_of")).where((F.col("rows_of") >= MIN_ROWS) | (F.col("g") == EVERYTHING))
    estimates = stage(fit(grouped.join(stage(sizes, "sizes").select("g"), "g", "left_semi")), "mcd")
    known = lambda level: estimates.select(F.col("g").alias(level), F.lit(True).alias(f"{level}_known"))
    keyed = rows.withColumn("own", own).withColumn("pooled", pooled).join(known("own"), "own", "left").join(known("pooled"), "pooled", "left")
    chosen = keyed.withColumn("g", F.when(F.col("own_known"), F.col("own")).when(F.col("pooled_known"), F.col("pooled")).otherwise(F.lit(EVERYTHING)))
    dist = _distance(chosen.join(estimates, "g", "left"))
    return dist.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       (~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))).alias("kept"), "d2")


def op9(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return rules(docs)
