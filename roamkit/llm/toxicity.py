"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: lower-cased words and their first 4, 5 and 6 letters,
hashed to ``BITS`` bits.  Terms whose presence tells the classes apart beyond chance are
chosen from all sampled labelled documents; the machine gives each a weight and a factor
vector, so that pairs of terms add their inner product to the linear sum.

Training takes at most about ``SAMPLE`` labelled documents of each class, chosen by a hash
of the id (a documented bound; all are taken while there are fewer).  Each counts in the
loss as many times as its class was thinned out, so that scores keep the natural share of
toxic documents; the choice of terms compares classes and counts the sample as it is.
Their chosen terms, a few numbers a document, are fitted on the driver.  Scoring reads whole texts, scans
once and shuffles nothing.

Defined cases: NULL text counts as empty; a text without chosen terms (an empty one too)
gets the score of the bias alone; without labels of both classes every score is the
smoothed share of toxic labels; a doc_id with several labels is toxic if any is; rows
without a doc_id are held out; repeated rows are scored each; an empty table gives no
rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.llm.shared import python_tasks, stage

BITS, SAMPLE, MAX_TERMS, FACTORS, THRESHOLD = 30, 8_000, 4_096, 4, 0.7
MASK, WORD = (1 << BITS) - 1, regex.compile(r"\w+")
#: Chunks whose terms a task keeps while it scores, and letters of the longest one kept: about 15 MB, freed with the task.
KEPT, KEPT_LETTERS = 100_000, 32


def chunk_terms(chunk: str) -> list[int]:
    """Hashed terms of a lower-cased piece of text without white space."""
    out = []
    for w in WORD.findall(chunk):
        out.append(xxhash.xxh64_intdigest(w) & MASK)
        out += [xxhash.xxh64_intdigest(f"{k}:{w[:k]}") & MASK for k in (4, 5, 6) if len(w) > k]
    return out


def terms(text: str) -> set[int]:
    return {t for c in set(text.lower().split()) for t in chunk_terms(c)}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(True))


@dataclass(frozen=True)
class FactorizationMachine:
    terms: np.ndarray  # ascending hashed terms
    bias: float
    weight: np.ndarray
    factor: np.ndarray  # terms x FACTORS

    def scores(self, docs: list[list[int]]) -> np.ndarray:
        """Probability of class 1 for documents given as lists of places in ``terms``."""
        n, at = np.array([len(d) for d in docs], dtype=np.int64), np.array([i for d in docs for i in d], dtype=np.int64)
        return 1 / (1 + np.exp(-np.clip(margin(np.repeat(np.arange(len(docs)), n), at, len(docs), self.bias, self.weight, self.factor)[0], -30, 30)))


def margin(doc: np.ndarray, at: np.ndarray, n: int, bias: float, weight: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bias + linear sum + half of (square of sums - sum of squares), and the factor sums."""
    sums, squares = np.zeros((n, factor.shape[1])), np.bincount(doc, (factor[at] ** 2).sum(1), n)
    for k in range(factor.shape[1]):
        sums[:, k] = np.bincount(doc, factor[at, k], n)
    return bias + np.bincount(doc, weight[at], n) + 0.5 * ((sums**2).sum(1) - squares), sums


def fit(docs: list[list[int]], label: np.ndarray, chosen: np.ndarray, steps: int = 400, rate: float = 0.1, ridge: float = 1e-5, counts: np.ndarray | None = None) -> FactorizationMachine:
    """Logistic loss, full batches, Adam; the seed is fixed.  Document ``k`` stands for ``counts[k]`` documents."""
    n, m = len(docs), len(chosen)
    counts = np.ones(n) if counts is None else counts
    share = ((label * counts).sum() + 0.5) / (counts.sum() + 1)
    if m == 0 or label.min(initial=1) == label.max(initial=0):
        return FactorizationMachine(chosen, float(np.log(share / (1 - share))), np.zeros(m), np.zeros((m, FACTORS)))
    doc = np.repeat(np.arange(n), [len(d) for d in docs])
    at = np.array([i for d in docs for i in d], dtype=np.int64)
    value = np.concatenate([[np.log(share / (1 - share))], np.zeros(m), np.random.default_rng(0).normal(0, 0.01, m * FACTORS)])
    mean, var = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, steps + 1):
        weight, factor = value[1 : m + 1], value[m + 1 :].reshape(m, FACTORS)
        z, sums = margin(doc, at, n, value[0], weight, factor)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) * counts / counts.sum()
        grad = np.concatenate([[error.sum()], np.bincount(at, error[doc], m), *([np.zeros(m * FACTORS)])])
        slope = grad[m + 1 :].reshape(m, FACTORS)
        for k in range(FACTORS):
            slope[:, k] = np.bincount(at, error[doc] * (sums[doc, k] - factor[at, k]), m)
        grad[1:] += ridge * value[1:]
        mean, var = 0.9 * mean + 0.1 * grad, 0.99 * var + 0.01 * grad**2
        value = value - rate * (mean / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
    return FactorizationMachine(chosen, float(value[0]), value[1 : m + 1], value[m + 1 :].reshape(m, FACTORS))


def sample(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most about ``size`` labelled ids of each class outside the held-out third: (doc_id, toxic, stands_for)."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    count = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1_000_000))
    part = F.when(F.col("toxic") == 1, F.lit(size / max(1, count.get(1, 0)))).otherwise(F.lit(size / max(1, count.get(0, 0))))
    return known.where(place < part * 1_000_000).withColumn("stands_for", F.greatest(F.lit(1.0), 1 / part))


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> FactorizationMachine:
    python_tasks(docs.sparkSession)
    ids = stage(sample(labels, size), "labelled")
    # at most about 2 x size ids of 20 bytes: a proven bound for the broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [np.fromiter(terms(t), np.int64) for t in pdf["text"]]
            if not sets:
                continue
            term, at = np.unique(np.concatenate(sets), return_inverse=True)
            label = np.repeat(pdf["toxic"].to_numpy(), [len(s) for s in sets])
            yield pd.DataFrame({"term": term, "toxic": np.bincount(at, label, len(term)).astype(np.int64), "docs": np.bincount(at, minlength=len(term))})

    counted = rows.mapInPandas(count, "term long, toxic long, docs long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs")).where("docs > 1")
    counted = stage(counted, "terms")
    all_ = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    share = max(all_["toxic"] or 0, 0) / max(1, all_["n"])
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))
    kept, gone = F.col("toxic"), F.col("docs") - F.col("toxic")
    tell = 2 * (part(kept, F.col("docs") * share) + part(gone, F.col("docs") * (1 - share)))
    # likelihood ratio beyond what the best of so many terms reaches by chance
    least = 2 * float(np.log(max(2, counted.count())))
    best = counted.select("term", tell.alias("tell")).where(F.col("tell") > least).orderBy(F.desc("tell"), "term").limit(MAX_TERMS)
    chosen = np.sort(np.array([r["term"] for r in best.collect()], dtype=np.int64))
    place = {int(t): i for i, t in enumerate(chosen)}

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "stands_for": pdf["stands_for"], "at": [sorted(place[t] for t in terms(x) & place.keys()) for x in pdf["text"]]})

    got = rows.mapInPandas(found, "doc_id long, toxic int, stands_for double, at array<int>").orderBy("doc_id", "at").collect() if len(chosen) else rows.select("toxic", "stands_for").withColumn("at", F.array()).collect()
    return fit([list(r["at"]) for r in got], np.array([r["toxic"] for r in got], dtype=float), chosen, counts=np.array([r["stands_for"] for r in got], dtype=float))


def places(texts: Iterable[str], place: dict[int, int], seen: dict[str, tuple[int, ...]]) -> list[list[int]]:
    """Places of each text's chosen terms; ``seen`` takes those of chunks, up to ``KEPT`` of them."""
    docs_at = []
    for text in texts:
        hits: set[int] = set()
        for chunk in set(text.lower().split()):
            got = seen.get(chunk)
            if got is None:
                got = tuple(place[t] for t in chunk_terms(chunk) if t in place)
                if len(seen) < KEPT and len(chunk) <= KEPT_LETTERS:
                    seen[chunk] = got
            if got:
                hits.update(got)
        docs_at.append(sorted(hits))
    return docs_at


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """doc_id and score of every row."""
    python_tasks(docs.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {int(t): i for i, t in enumerate(model.terms)}
        seen: dict[str, tuple[int, ...]] = {}  # of this task: a worker outlives many models
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": model.scores(places(pdf["text"], place, seen))})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(work, "doc_id long, score double")


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
