"""The work of BM25 search: shards searched once, matrices of similar documents, weights that change."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from roamkit.llm import search



def file_of(lists, first_id=0):
    """A file of an index, as ``write_index`` saves it, of documents that are lists of terms."""
    term, count = zip(*(np.unique(np.array(x, np.int64), return_counts=True) for x in lists), strict=True)
    doc, term, count = np.repeat(np.arange(len(lists), dtype=np.int32), [len(t) for t in term]), np.concatenate(term), np.concatenate(count)
    order = np.argsort(term, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0][: len(term)])
    return {"doc_id": first_id + np.arange(len(lists), dtype=np.int64), "length": np.array([len(x) for x in lists], np.int32), "term": term[order][first],
            "start": np.r_[first, len(term)], "doc": doc[order], "count": count[order].astype(np.int32)}


def plain(lists, terms, idf, mean, k):
    """(score, doc_id) of the k best, by scoring every document."""
    weight, found = dict(zip(terms.tolist(), idf.tolist(), strict=True)), []
    for doc_id, x in enumerate(lists):
        held, count = np.unique(np.array(x, np.int64), return_counts=True)
        s = sum(weight[t] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t, c in zip(held.tolist(), count.tolist(), strict=True) if t in weight)
        found += [(-round(s, 6), doc_id)] if s > 0 else []
    return sorted(found)[:k]


@pytest.fixture(scope="module")
def two_tongues():
    """6,000 documents in two vocabularies that share few terms, dealt in turn, with equal and empty ones among them."""
    rng = np.random.default_rng(3)
    lists = [[int(x) + 10_000 * (n % 2) if rng.random() < 0.98 else int(x) for x in np.minimum(rng.zipf(1.25, rng.integers(1, 60)), 9_000)] for n in range(6_000)]
    lists[50:60] = [lists[40]] * 10
    lists[70:75] = [[]] * 5
    return lists


def test_similar_documents_share_a_matrix(two_tongues):
    """The result is that of scoring all; a document is multiplied with the common terms of its like, not with all common ones."""
    lists = two_tongues
    shard = search.Shard([file_of(lists[:2_500]), file_of(lists[2_500:], 2_500)], 30.0)
    df = np.diff(shard.start)
    idf = np.log1p((6_000 - df + 0.5) / (df + 0.5))
    asked = [np.unique(lists[q]) for q in (0, 1, 40, 777, 2_600, 5_999)]
    asked = [(terms, idf[np.searchsorted(shard.term, terms)]) for terms in asked]
    want = [plain(lists, *q, 30.0, 10) for q in asked]
    for least in (None, -1.0):
        got = list(shard.search_all([(*q, -w[-1][0] if least is None else least) for q, w in zip(asked, want, strict=True)], 10))
        for (docs, scores), w in zip(got, want, strict=True):
            assert shard.doc_id[docs].tolist() == [d for _, d in w] and np.allclose(scores, [-s for s, _ in w], atol=2e-6)
    matrices = getattr(shard, "matrices", None) or [(np.flatnonzero(shard.row >= 0), shard.matrix)]
    terms = np.unique(np.concatenate([rows for rows, _ in matrices]))
    assert len(terms) > 30 and sum(m.size for _, m in matrices) < 0.7 * len(terms) * 6_000


def test_weights_may_change(two_tongues):
    """A term may have another weight in a later query, or in another one of the same call."""
    lists = two_tongues[:800]
    shard = search.Shard([file_of(lists)], 30.0)
    rng = np.random.default_rng(5)
    asked = [(terms, rng.random(len(terms)) * 5 + 0.1) for terms in (np.unique(lists[q]) for q in (0, 2, 4, 0, 40, 1))]
    for got in (list(shard.search_all([(*q, -1.0) for q in asked], 10)), [shard.search(*q, 10) for q in asked]):
        for (docs, scores), q in zip(got, asked, strict=True):
            w = plain(lists, *q, 30.0, 10)
            assert shard.doc_id[docs].tolist() == [d for _, d in w] and np.allclose(scores, [-s for s, _ in w], atol=2e-6)


def test_long_queries_in_pieces(two_tongues, monkeypatch):
    """A query whose lists are added up in several pieces, and one without a term of the shard."""
    lists = two_tongues[:1_500]
    monkeypatch.setattr(search, "WALKED", 300, raising=False)
    shard = search.Shard([file_of(lists)], 30.0)
    every, none = np.unique(np.concatenate([np.array(x, np.int64) for x in lists])), np.array([-5, 10**12])
    idf = 1.0 + np.arange(len(every)) % 7
    (docs, scores), nothing = shard.search_all([(every, idf, -1.0), (none, np.ones(2), -1.0)], 10)
    want = plain(lists, every, idf, 30.0, 10)
    assert shard.doc_id[docs].tolist() == [d for _, d in want] and np.allclose(scores, [-s for s, _ in want], atol=2e-6)
    assert len(nothing[0]) == len(nothing[1]) == 0


def test_shards_without_terms():
    shard = search.Shard([file_of([[], [], [7]]), file_of([[]] * 5_000, 3)], 1.0)
    docs, scores = shard.search(np.array([7]), np.array([2.0]), 10)
    assert shard.doc_id[docs].tolist() == [2] and np.allclose(scores, [2.0])


def test_each_shard_is_searched_once(spark, monkeypatch):
    """The shards that give the thresholds are not searched again; frequencies added up in many steps are the same."""
    rng = np.random.default_rng(12)
    rows = [(k if k % 89 else None, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 40) if x < 3000)) for k in range(600)] + [(700, None), (50, ", w1; w2 w3 ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).persist()
    asked = docs.where("doc_id % 5 = 0").select(F.col("doc_id").alias("query_id"), "text")

    def found():
        return [tuple(r) for r in search.search(docs, asked, 10).orderBy("query_id", "rank").collect()]

    want, passes, each_shard = found(), [], search.each_shard
    with monkeypatch.context() as m:
        m.setattr(search, "SHARD_POSTINGS", 700)
        m.setattr(search, "QUERY_TERMS", 500)
        m.setattr(search, "SUMMED", 100, raising=False)
        m.setattr(search, "each_shard", lambda groups, *rest: passes.append({r["group"] for r in groups.select("group").collect()}) or each_shard(groups, *rest))
        got = found()
    lead, others = passes
    assert lead and others and not lead & others
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], atol=2e-6)
