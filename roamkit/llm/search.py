"""Exact BM25 top-k by an inverted index per shard: common terms as a matrix, the others as lists.

Index: each scan task turns its documents into files of at most ``SHARD_POSTINGS``
postings, by term, then document; documents are numbered within the shard.  Document
frequencies, the number of documents and their mean length are summed over all shards, so
that scores are the same whatever the sharding.

Search: a task holds files of at most about ``SHARD_POSTINGS`` postings as one shard, and
blocks of queries one after another.  A shard's documents, and a block's queries, are put in an
order in which those with the same common terms are side by side.  Each run of at most ``PIECE``
documents has a matrix of impacts of the terms that at least ``COMMON`` of them hold.  Queries are
searched a batch at a time: a batch is multiplied with those rows of the matrices that pay
(``PAYS``: they are asked for and held often enough), and all other postings of its terms are
added up query by query.  Both are in single precision.  What that may have lost is bounded, so
the documents that can be among the k best are known; these alone are scored again, in double
precision, from the postings by document.  No document is left out otherwise.

If there are ``LEAD`` shards or more, a first pass searches one of ``LEAD``: the k-th best score
there is a lower bound of the query's k-th score, and the second pass, over the other shards, gives
only documents that reach it.  So a query brings about k times ``LEAD`` rows to the merge,
however many shards there are.  Shards' lists merge exactly, as the scores are global.
Queries with the same terms are searched once.

Terms are runs of letters and digits, lower-cased, known by 64-bit hash.  A query is the set
of the terms of its whole text.  Scores are rounded to ``DIGITS`` digits and ties go to the
smaller doc_id.

Defined cases: NULL text counts as empty; a document without terms is found by no query, and
a query without terms finds nothing; only documents that share a term are found, so a query
may have fewer than k rows; rows without a doc_id are found but rank last among ties; rows
that share a doc_id are documents of their own; queries that share a query_id are one query
with the terms of all; an empty table gives no rows; columns other than doc_id and text are
ignored.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamkit.llm.shared import open_store, python_tasks, run_dir, stage

K1, B, DIGITS = 1.2, 0.75, 6
#: What a score may be below a threshold and still be equal to it once rounded.
SLACK = 10.0**-DIGITS
#: Bound on a file, and on the files that a task searches as one: 8 bytes a posting on disk, about 40 in a task.
SHARD_POSTINGS = 7_000_000
#: Terms of files whose documents are added up in a task before the shuffle, about 60 bytes each.
SUMMED = 1_500_000
#: Terms of queries that a search task holds at once, 16 bytes each.
QUERY_TERMS = 1_000_000
#: Lists shorter than this are gathered by their places, others as a whole; postings that are added up at once.
SHORT, WALKED = 32, 64_000
#: Documents of a matrix at most.
PIECE = 4096
#: A term is in a matrix from this share of its documents on, and this many; numbers of a shard's matrices at most.
COMMON, LISTED, MATRIX = 0.08, 32, 16_000_000
#: Seconds that a product of a matrix takes, by those that adding up a posting takes.
PAYS = 0.01
#: Scores (or weights) that a batch of queries may have at once, and postings that are scored again at once.
BATCH, SCORES = 4_000_000, 2_000_000
#: Queries that ``side_by_side`` leaves in any order, most terms and numbers that it looks at.
ALIKE, ALIKE_TERMS, ALIKE_SIZE = 64, 512, 8_000_000
#: Queries whose rows leave a search task together, and blocks of queries that a task takes.
ROWS_OF, TASK_BLOCKS = 2_000, 64
#: One of so many shards is searched for the first thresholds.
LEAD = 8
NO_DOC = -(2**63)
#: A posting in a list: its part of the score, and its document.
POSTING = np.dtype([("near", np.float32), ("doc", np.int32)])


def hashed_terms(text: Column) -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")  # the first and the last may be empty
    return F.array_remove(F.transform(words, lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))


def _save(store, path: str, **arrays) -> None:
    data = io.BytesIO()
    np.savez(data, **arrays)
    with store.open_output_stream(path) as f:
        f.write(data.getvalue())


def _load(store, path: str) -> dict[str, np.ndarray]:
    with store.open_input_stream(path) as f, np.load(io.BytesIO(f.read())) as z:
        return dict(z)


def write_index(docs: DataFrame, folder: str) -> DataFrame:
    """Write the shards: path, docs, terms (in all documents) and the number of postings."""
    python_tasks(docs.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        held, postings = [], 0  # (doc_id, length, distinct terms, counts)

        def flush() -> pd.DataFrame:
            path = f"{root}/{uuid.uuid4().hex}.npz"
            doc = np.repeat(np.arange(len(held), dtype=np.int32), [len(h[2]) for h in held])
            term, count = np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held])
            order = np.argsort(term, kind="stable")
            term, doc, count = term[order], doc[order], count[order]
            first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][: len(term)])
            _save(store, path, doc_id=np.array([h[0] for h in held], np.int64), length=np.array([h[1] for h in held], np.int32), term=term[first], start=np.r_[first, len(term)], doc=doc, count=count.astype(np.int32))
            return pd.DataFrame({"path": [path], "docs": [len(held)], "terms": [sum(h[1] for h in held)], "postings": [len(term)]})

        for pdf in batches:
            for doc_id, words in zip(pdf["doc"], pdf["words"], strict=True):
                term, count = np.unique(np.asarray(words, np.int64), return_counts=True)
                held.append((doc_id, len(words), term, count))
                postings += len(term)
                if postings >= SHARD_POSTINGS:
                    yield flush()
                    held, postings = [], 0
        if held:
            yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC)).alias("doc"), hashed_terms(F.col("text")).alias("words"))
    return rows.mapInPandas(write, "path string, docs long, terms long, postings long")


def document_frequencies(shards: DataFrame, folder: str) -> DataFrame:
    """(term, df) over all shards."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_store(folder)
        held = []  # terms and their documents, of some files

        def summed() -> Iterator[pd.DataFrame]:
            term, df = (np.concatenate([h[x] for h in held]) for x in (0, 1))
            held.clear()
            order = np.argsort(term, kind="stable")
            term, df = term[order], df[order]
            first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]][: len(term)])
            term, df = term[first], np.add.reduceat(df, first) if len(first) else df
            for a in range(0, len(term), 100_000):
                yield pd.DataFrame({"term": term[a : a + 100_000], "df": df[a : a + 100_000]})

        for pdf in batches:
            for path in pdf["path"]:
                z = _load(store, path)
                held.append((z["term"], np.diff(z["start"])))
                if sum(len(h[0]) for h in held) > SUMMED:
                    yield from summed()
        if held:
            yield from summed()

    files, cores = shards.count(), shards.sparkSession.sparkContext.defaultParallelism
    return shards.select("path").repartition(max(1, min(files, 2 * cores), -(-files // 8))).mapInPandas(read, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Shard:
    """The postings of some files, by term and by document."""

    def __init__(self, files: Iterable[dict[str, np.ndarray]], mean: float):
        files = list(files)
        first = np.cumsum([0, *(len(z["doc_id"]) for z in files)])
        self.doc_id = np.concatenate([z["doc_id"] for z in files])
        term = np.sort(np.concatenate([z["term"] for z in files]))
        self.term = term[np.r_[True, term[1:] != term[:-1]][: len(term)]]
        self.norm = K1 * (1 - B + B * np.concatenate([z["length"] for z in files]) / mean)
        term = np.concatenate([np.repeat(np.searchsorted(self.term, z["term"]).astype(np.int32), np.diff(z["start"])) for z in files])
        doc = np.concatenate([z["doc"] + np.int32(n) for z, n in zip(files, first, strict=False)])
        count = np.concatenate([z["count"] for z in files])
        del files
        docs = len(self.doc_id)
        pieces = -(-docs // PIECE)
        self.bounds = [docs * p // pieces for p in range(pieces + 1)]  # of the matrices' documents
        if pieces > 1:  # documents with the same common terms get places side by side
            order = side_by_side(doc, term, docs, PIECE // 4)
            self.doc_id, self.norm = self.doc_id[order], self.norm[order]
            place = np.empty(docs, np.int32)
            place[order] = np.arange(docs)
            doc = place[doc]
        self.tie = np.where(self.doc_id == NO_DOC, np.iinfo(np.int64).max, self.doc_id)
        # the postings by document, each document's in the order of the terms
        order = stable_order(doc)
        doc = doc[order]
        self.terms_of = term[order]
        del term
        self.count_of = count[order]
        del count, order
        self.start_of = np.r_[0, np.cumsum(np.bincount(doc, minlength=docs))]
        self.held = np.bincount(self.terms_of, minlength=len(self.term))
        self.start = np.r_[0, np.cumsum(self.held)]
        self.asked, self.weight = np.zeros(len(self.term), bool), np.zeros(len(self.term))  # scratch of score
        # matrices of impacts by term and document
        self.matrices, inside, self.spread = [], np.zeros(len(doc), bool), np.zeros(len(self.term), np.int64)
        for a, b in zip(self.bounds[:-1], self.bounds[1:], strict=True):
            span = slice(self.start_of[a], self.start_of[b])
            held = np.bincount(self.terms_of[span], minlength=len(self.term))
            rows = np.flatnonzero(held >= max(LISTED, COMMON * (b - a)))
            rows = rows[np.argsort(-held[rows], kind="stable")[: MATRIX // docs]]
            row = np.full(len(self.term), -1, np.int32)
            row[rows] = np.arange(len(rows))
            at = row[self.terms_of[span]]
            inside[span] = at >= 0
            hit = np.flatnonzero(at >= 0) + span.start
            matrix = np.zeros((len(rows), b - a), np.float32)
            matrix[row[self.terms_of[hit]], doc[hit] - a] = self.impact(self.count_of[hit], doc[hit])
            self.matrices.append((rows, matrix))
            self.spread[rows] += b - a
        common = np.flatnonzero(self.spread)
        self.common = np.full(len(self.term), -1)
        self.common[common] = np.arange(len(common))
        self.rows = []  # of each matrix, by common term; the last for none
        for rows, _ in self.matrices:
            self.rows.append(np.full(len(common) + 1, -1))
            self.rows[-1][self.common[rows]] = np.arange(len(rows))
        self.spread = self.spread[common]
        # the postings by term, each term's first those that are in no matrix
        self.lists = stable_order(self.terms_of * np.int32(2) + inside)  # their places by document, for now
        self.rest = np.bincount(self.terms_of[~inside], minlength=len(self.term))
        self.dense = (self.held - self.rest)[common]
        del inside
        # for walk: impacts times ``scale``, and documents; copied and gathered as whole numbers of 8 bytes
        self.scale, self.scaled = np.ones(len(self.term)), 0
        self.doc, self.near = self.lists.view(POSTING)["doc"], self.lists.view(POSTING)["near"]
        for n in range(0, len(doc), SCORES):
            own = self.lists[n : n + SCORES].copy()
            self.doc[n : n + SCORES] = doc[own]
            self.near[n : n + SCORES] = self.impact(self.count_of[own], doc[own])
        del doc
        self.views, self.view, whole = [], [], memoryview(self.lists).cast("B")  # long lists: of all postings, and of those that are in no matrix
        for held in (self.held, self.rest):
            long = np.flatnonzero(held >= SHORT)
            self.view.append(np.full(len(self.term), -1))
            self.view[-1][long] = np.arange(len(long)) + len(self.views)
            self.views += [whole[8 * a : 8 * (a + n)] for a, n in zip(self.start[long].tolist(), held[long].tolist(), strict=True)]
        self.docs = np.empty(WALKED + max([0, *self.held]), np.int64)  # scratch of walk
        self.got = np.empty((0, docs), np.float32)  # scratch of search_places

    def impact(self, count: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return count * (K1 + 1) / (count + self.norm[doc])

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The places of terms, -1 for those that the shard does not hold."""
        at = np.minimum(np.searchsorted(self.term, terms), len(self.term) - 1)
        return np.where(self.term[at] == terms, at, -1)

    def walk(self, asked: tuple[np.ndarray, np.ndarray, np.ndarray], got: np.ndarray, n: np.ndarray) -> None:
        """Add to a query's row of ``got`` the lists of its terms, for each of a batch.

        asked: places of terms, whether the matrices count for a term, and the bounds of each query's terms; n: the lengths of the lists.
        """
        at, multiplied, cut = asked
        view = np.where(multiplied, self.view[1][at], self.view[0][at])
        long, few = view >= 0, np.flatnonzero((view < 0) & (n > 0))
        views, of_view, of_few = [self.views[x] for x in view[long].tolist()], np.r_[0, np.cumsum(long)][cut], np.searchsorted(few, cut)
        first, last = self.start[at[few]], self.start[at[few]] + n[few]
        in_views, in_few = np.r_[0, np.cumsum(n[long])], np.r_[0, np.cumsum(n[few])]
        for x, y in runs(in_few[of_few[1:]], SCORES):
            short = memoryview(self.lists[ranges(first[of_few[x] : of_few[y]], last[of_few[x] : of_few[y]])]).cast("B")
            places = (8 * (in_few[of_few[x : y + 1]] - in_few[of_few[x]])).tolist()
            for row, a, b, c, d in zip(got[x:y], of_view[x:y].tolist(), of_view[x + 1 : y + 1].tolist(), places[:-1], places[1:], strict=True):
                if in_views[b] - in_views[a] + (d - c) // 8 <= WALKED:
                    self.add_up(row, [*views[a:b], short[c:d]])
                else:
                    for e, f in runs(in_views[a + 1 : b + 1] - in_views[a], WALKED):
                        self.add_up(row, views[a + e : a + f])
                    for e in range(c, d, 8 * WALKED):
                        self.add_up(row, [short[e : min(d, e + 8 * WALKED)]])

    def add_up(self, row: np.ndarray, lists: list[memoryview]) -> None:
        if joined := b"".join(lists):
            postings = np.frombuffer(joined, POSTING)
            docs = self.docs[: len(postings)]
            docs[:] = postings["doc"]
            np.add.at(row, docs, postings["near"])

    def weigh(self, at: np.ndarray, idf: np.ndarray) -> bool:
        """From now on the lists of these terms hold impacts times these weights, unless a term has two."""
        stale = np.flatnonzero(self.scale[at] != idf)
        if not len(stale):
            return True
        stale = stale[np.unique(at[stale], return_index=True)[1]]
        self.scaled += bool((self.scale[at[stale]] != 1).any())
        for a, b in runs(np.cumsum(self.held[at[stale]]), SCORES):
            t, w = at[stale[a:b]], idf[stale[a:b]]
            self.near[ranges(self.start[t], self.start[t + 1])] *= np.repeat(w / self.scale[t], self.held[t])
        self.scale[at[stale]] = idf[stale]
        return not (self.scale[at] != idf).any()

    def look_up(self, t: int, docs: np.ndarray) -> np.ndarray:
        """The impacts of one term in the given documents, 0 where it is not."""
        own = ranges(self.start_of[docs], self.start_of[docs + 1])
        which = np.repeat(np.arange(len(docs)), self.start_of[docs + 1] - self.start_of[docs])
        hit = self.terms_of[own] == t
        found = np.zeros(len(docs))
        found[which[hit]] = self.impact(self.count_of[own[hit]], docs[which[hit]])
        return found

    def score(self, docs: np.ndarray, at: np.ndarray, idf: np.ndarray) -> np.ndarray:
        """The scores of some documents for the terms at the given places."""
        a, b = self.start_of[docs], self.start_of[docs + 1]
        self.asked[at], self.weight[at] = True, idf
        got = []
        for x, y in runs(np.cumsum(b - a), SCORES):
            terms = np.concatenate([self.terms_of[c:d] for c, d in zip(a[x:y].tolist(), b[x:y].tolist(), strict=True)])
            hit = np.flatnonzero(self.asked[terms])
            ends = np.cumsum(b[x:y] - a[x:y])
            which = np.searchsorted(ends, hit, side="right")
            own = hit + (b[x:y] - ends)[which]
            got.append(np.bincount(which, self.weight[terms[hit]] * self.impact(self.count_of[own], docs[x:y][which]), y - x))
        self.asked[at] = False
        return np.round(np.concatenate(got), DIGITS)

    def search_all(self, queries: list[tuple[np.ndarray, np.ndarray, float]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``search`` for each of some queries (terms, idf, least)."""
        if queries:
            cut = np.cumsum([0, *(len(terms) for terms, _, _ in queries)])
            yield from self.search_places(self.find(np.concatenate([q[0] for q in queries])), np.concatenate([q[1] for q in queries]), cut, [q[2] for q in queries], k)

    def search_places(self, places: np.ndarray, idfs: np.ndarray, cut: np.ndarray, least: list[float], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``search`` for each of some queries, batch by batch: places of terms (-1: not in the shard), idf, the bounds of each query's terms, least."""
        size = max(1, BATCH // max(1, len(self.spread), len(self.doc_id)))
        here = np.r_[0, np.cumsum(places >= 0)][cut]
        for first in range(0, len(least), size):
            batch, span = least[first : first + size], slice(cut[first], cut[min(first + size, len(least))])
            found = places[span] >= 0
            at, idf, bounds = places[span][found], idfs[span][found], here[first : first + size + 1] - here[first]
            if not self.weigh(at, idf) and len(batch) > 1:  # queries differ in a term's weight
                for n, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    yield from self.search_places(at[a:b], idf[a:b], np.array([0, b - a]), batch[n : n + 1], k)
                continue
            common = self.common[at]
            asks = np.bincount(common + 1, minlength=len(self.spread) + 1)[1:]
            used = np.flatnonzero(asks * self.dense > PAYS * len(batch) * self.spread)
            column = np.full(len(self.spread) + 1, -1)  # the last: of terms that are in no matrix
            column[used] = np.arange(len(used))
            column = column[common]
            asked, multiplied = np.zeros((len(batch), len(used)), np.float32), column >= 0
            asked[np.repeat(np.arange(len(batch)), np.diff(bounds))[multiplied], column[multiplied]] = idf[multiplied]
            if len(self.got) < len(batch):
                self.got = np.empty((len(batch), len(self.doc_id)), np.float32)
            got = self.got[: len(batch)]
            for (_, matrix), rows, a, b in zip(self.matrices, self.rows, self.bounds[:-1], self.bounds[1:], strict=True):
                rows = rows[used]
                np.matmul(asked[:, rows >= 0], matrix[rows[rows >= 0]], out=got[:, a:b])
            self.walk((at, multiplied, bounds), got, np.where(multiplied, self.rest[at], self.held[at]))
            spans = zip(got, bounds[:-1].tolist(), bounds[1:].tolist(), batch, strict=True)
            yield from [self.best(near, at[a:b], idf[a:b], k, lowest) for near, a, b, lowest in spans]

    def best(self, near: np.ndarray, at: np.ndarray, idf: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """The result of ``search``, given each document's score but for the error of single precision."""
        # sums of n products of single precision, none negative: off by n + 3 roundings of 2 ** -24 at most
        error = (len(at) + 8 + self.scaled) * 2.0**-24
        error /= 1 - error

        def reach(least: float) -> np.float32:
            return np.float32(max(0.0, (least - SLACK) * (1 - error)))

        if least <= 0:
            # the k-th of the best of some groups of documents is at most the k-th of all
            groups = max(1, len(near) // 32)
            heads = near[: len(near) // groups * groups].reshape(-1, groups).max(axis=0) if groups >= k else near
            if len(heads) >= k:
                least = float(np.partition(heads, -k)[-k]) * (1 - error)
        docs = np.flatnonzero(near > reach(least)) if len(near) and near.max() > reach(least) else np.zeros(0, np.int64)
        if len(docs) > k:
            least = max(least, float(np.partition(near[docs], -k)[-k]) * (1 - error))
            docs = docs[near[docs] > reach(least)]
        if not len(docs):
            return docs, np.zeros(0)
        sums = self.score(docs, at, idf)
        order = np.lexsort((self.tie[docs], -sums))[:k]
        return docs[order], sums[order]

    def search(self, terms: np.ndarray, idf: np.ndarray, k: int, least: float = -1.0) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents (places in the shard) with at least the score ``least``, and their scores, best first."""
        return next(self.search_all([(terms, idf, least)], k))

    def seeds(self, terms: np.ndarray, idf: np.ndarray, k: int) -> np.ndarray:
        """The k best scores in this shard (fewer if there are not so many), best first."""
        return self.search(terms, idf, k)[1]


def stable_order(key: np.ndarray) -> np.ndarray:
    """``argsort`` of numbers from 0 to 2 ** 31, equal ones in their order."""
    both = key.astype(np.int64)
    both <<= 32
    both |= np.arange(len(key), dtype=np.int32)
    both.sort()
    both &= 2**32 - 1
    return both


def runs(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of items; ``ends``: the sum up to each item, which grows by about ``most`` in a run, or by one item."""
    cuts = (np.flatnonzero(np.diff(ends // most)) + 1).tolist() if len(ends) and ends[-1] > most else []
    return zip([0, *cuts], [*cuts, len(ends)], strict=True)


def ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All integers of the ranges [a, b), one after another."""
    n = b - a
    return np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())


def side_by_side(which: np.ndarray, term: np.ndarray, n: int, leaf: int) -> np.ndarray:
    """An order of ``n`` texts in which those with the same common terms are near each other; text ``which`` has ``term``, for each of the pairs.

    Halved at the middle of the direction in which they differ most, until ``leaf`` texts are left.
    """
    asks = np.bincount(term)
    common = np.argsort(-asks, kind="stable")[: min(ALIKE_TERMS, ALIKE_SIZE // max(1, n))]
    column = np.full(len(asks), -1, np.int32)
    column[common] = np.arange(len(common))
    hit = np.flatnonzero(column[term] >= 0)
    holds = np.zeros((n, len(common)), np.float32)
    holds[which[hit], column[term[hit]]] = 1
    parts, done = [np.arange(n)], []
    while parts:
        part = parts.pop()
        if len(part) <= leaf or not len(common):
            done.append(part)
            continue
        own = holds[part]
        own -= own.mean(axis=0)
        way = own[np.argmax((own * own).sum(axis=1))]
        for _ in range(6):
            way = (own @ way) @ own
            way /= max(1e-9, float(np.linalg.norm(way)))
        place = np.argsort(own @ way, kind="stable")
        parts += [part[place[len(part) // 2 :]], part[place[: len(part) // 2]]]
    return np.concatenate(done)


def write_blocks(queries: DataFrame, folder: str, parts: int, name: str) -> DataFrame:
    """Write queries (query, terms, idf, least) to ``parts`` files, for every shard to read; their names."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        held = [pdf for pdf in batches if len(pdf)]
        if held:
            path, rows = f"{root}/{uuid.uuid4().hex}-queries.npz", pd.concat(held)
            vocabulary, first, term = np.unique(np.concatenate(list(rows["terms"])), return_index=True, return_inverse=True)
            idf = np.concatenate(list(rows["idf"]))[first]
            cut = np.cumsum([0, *map(len, rows["terms"])])
            order = side_by_side(np.repeat(np.arange(len(rows)), np.diff(cut)), term, len(rows), ALIKE)
            term = term[ranges(cut[order], cut[order + 1])].astype(np.int32)
            cut = np.r_[0, np.cumsum(np.diff(cut)[order])]
            _save(store, path, query=rows["query"].to_numpy()[order], least=rows["least"].to_numpy(np.float64)[order], cut=cut, term=term, vocabulary=vocabulary, idf=idf)
            yield pd.DataFrame({"queries": [path]})

    return stage(queries.repartition(parts).mapInPandas(write, "queries string"), name)


def each_shard(groups: DataFrame, blocks: DataFrame, folder: str, k: int) -> DataFrame:
    """(query, doc_id, score): the k best of each shard that reach the query's ``least``, for every query in every shard.

    What is paired are names of files.  A task reads its shard once and searches it for up to ``TASK_BLOCKS`` blocks of
    queries; where there are more blocks, or fewer shards than cores, several tasks deal the blocks of a shard among them.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_store(folder)
        for pdf in batches:
            for paths, mean, names in zip(pdf["paths"], pdf["mean"], pdf["names"], strict=True):
                shard = Shard((_load(store, p) for p in sorted(paths)), mean)
                for name in names if len(shard.term) else []:
                    q = _load(store, name)
                    places, idf = shard.find(q["vocabulary"])[q["term"]], q["idf"][q["term"]]
                    for first in range(0, len(q["query"]), ROWS_OF):
                        span = slice(first, first + ROWS_OF)
                        cut = q["cut"][first : first + ROWS_OF + 1]
                        own = slice(cut[0], cut[-1])
                        docs, scores = zip(*shard.search_places(places[own], idf[own], cut - cut[0], q["least"][span].tolist(), k), strict=True)
                        query = np.repeat(q["query"][span], [len(x) for x in docs])
                        yield pd.DataFrame({"query": query, "doc_id": shard.doc_id[np.concatenate(docs)], "score": np.concatenate(scores)})

    shards, files = max(1, groups.count()), max(1, blocks.count())
    lanes = min(files, max(-(-files // TASK_BLOCKS), -(-groups.sparkSession.sparkContext.defaultParallelism // shards)))
    dealt = blocks.withColumn("lane", F.pmod(F.row_number().over(Window.orderBy("queries")), F.lit(lanes))).groupBy("lane").agg(F.collect_list("queries").alias("names"))
    tasks = groups.select("paths", "mean").crossJoin(F.broadcast(dealt))
    return tasks.repartition(shards * lanes).mapInPandas(run, "query long, doc_id long, score double")


def search(docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best rows of ``docs`` for each query (query_id, text)."""
    spark = docs.sparkSession
    folder = run_dir(spark, "inverted")
    shards = stage(write_index(docs, folder), "shards")
    total = shards.agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    n, mean = total["docs"] or 0, max(1.0, (total["terms"] or 0) / max(1, total["docs"] or 0))
    # small files are searched together: a running sum over the files' names and sizes
    end = F.sum("postings").over(Window.orderBy("path"))
    groups = shards.select("path", F.floor((end - F.col("postings") / 2) / SHARD_POSTINGS).alias("group")).groupBy("group")
    groups = stage(groups.agg(F.collect_list("path").alias("paths")).select("group", "paths", F.lit(mean).alias("mean")), "groups")

    asked = queries.select("query_id", F.explode(F.array_distinct(hashed_terms(F.col("text")))).alias("term")).distinct()
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = asked.hint("merge").join(document_frequencies(shards, folder), "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", idf.alias("idf")))).alias("t"))
    text_key = F.sha2(F.concat_ws(",", F.col("t.term").cast("array<string>")), 256)
    weighed = stage(weighed.select("query_id", text_key.alias("text_key"), F.col("t.term").alias("terms"), F.col("t.idf").alias("idf")), "queries")
    once = weighed.groupBy("text_key").agg(F.min("query_id").alias("query"))
    members = stage(weighed.select("query_id", "text_key").join(once, "text_key").select("query_id", "query"), "members")
    once = members.where("query = query_id").select("query").join(weighed, F.col("query") == F.col("query_id")).select("query", "terms", "idf")
    asked_terms = once.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = max(1, -(-asked_terms // QUERY_TERMS))

    best_first = Window.partitionBy("query").orderBy(F.desc("score"), (F.col("doc_id") == NO_DOC), "doc_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    first, lead = once.withColumn("least", F.lit(-1.0)), F.col("group") % LEAD == LEAD - 1
    if groups.where(lead).isEmpty():
        ranked = best(each_shard(groups, write_blocks(first, folder, parts, "query-blocks"), folder, k))
    else:
        seen = stage(best(each_shard(groups.where(lead), write_blocks(first, folder, parts, "lead-blocks"), folder, k)), "lead")
        least = seen.where(F.col("rank") == k).select("query", F.col("score").alias("bound"))
        once = first.join(least, "query", "left").withColumn("least", F.coalesce("bound", "least")).drop("bound")
        ranked = best(each_shard(groups.where(~lead), write_blocks(once, folder, parts, "query-blocks"), folder, k).unionByName(seen.drop("rank")))
    return ranked.join(members, "query").select("query_id", "rank", F.when(F.col("doc_id") != NO_DOC, F.col("doc_id")).alias("doc_id"), "score")


def op7(docs: DataFrame) -> DataFrame:
    """The registered query: every document whose id is divisible by 50, against all."""
    return search(docs, docs.where(F.col("doc_id") % 50 == 0).select(F.col("doc_id").alias("query_id"), "text"))
