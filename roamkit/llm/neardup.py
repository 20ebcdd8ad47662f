"""Near-duplicate groups by ProbMinHash signatures, banding and verification.

Documents are weighted sets: lower-cased five-word shingles, weighted by how often
they occur.  Equal texts are grouped first and only one of each goes on.  Every
shingle sends the arrivals of a Poisson process of its weight to the signature's
registers; arrivals later than every register's present minimum cannot change the
signature, so a shingle stops there (early termination).  Two registers agree with
the probability Jaccard of the documents.  A second signature gives every shingle the
weight 1, so that its registers agree with the plain Jaccard.

Bands of both signatures give buckets; a band's number and registers are its bucket's name, so
where both signatures are equal a document is in each bucket once.  Signatures, buckets and the
words of documents that share a bucket are written in tables bucketed by id, so that later joins
shuffle pairs and not texts.  Each of ``ROUNDS`` rounds takes the buckets whose
members are in several classes, names one member of the largest class leader, and verifies
every other document against the one of its buckets' leaders that it agrees with best; so
a large group is settled with a few pairs a member.  A last pass verifies what is left of
the pairs across classes, so that no candidate pair between two classes is left out;
pairs within a class are never made.  There, a bucket's members are dealt into blocks of
bounded size, and a pair of blocks is one row: its candidates (each pair only in the first
band that it shares) and, later, their texts, which travel once a pair of blocks instead of
once a pair.  A pair is linked when its exact
probability Jaccard, or the plain Jaccard of its distinct shingles, is ``SIMILARITY``
or more.  Classes are the connected components of the links.

A pair goes on to verification if ``MIN_AGREE`` registers of either signature agree.
Odds: at a probability Jaccard of 0.8 all bands of the first signature, and at a plain
Jaccard of 0.8 all bands of the second, miss with probability 3e-6, and fewer than
``MIN_AGREE`` of its 96 one-byte registers agree with probability of about 1e-5.

Defined cases: NULL text counts as empty; equal texts (empty ones too) are one class;
texts of fewer than five words are one shingle (words are compared by 32-bit hashes); a text without words has links to equal
texts only; rows that share a doc_id are one document, which the text with the smallest
hash stands for; rows without a doc_id give one row of NULLs; an empty table gives no
rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamkit.llm.shared import forget, python_tasks, stage, stage_by

WORDS, SIMILARITY = 5, 0.8
#: Signatures a document (weighted by counts, and unit weights), registers of each, registers a band.
KINDS, REGISTERS, ROWS = 2, 96, 4
BANDS = REGISTERS // ROWS
MIN_AGREE, ROUNDS = 58, 4
#: A block holds about so many documents and words.
BLOCK, BLOCK_WORDS = 256, 200_000
LONGS = KINDS * REGISTERS // 8
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection of 64-bit integers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document: document index, hash (sorted), weight."""
    n = np.array([len(w) for w in words], dtype=np.int64)
    if not n.sum():
        return (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0))
    flat = mixed(np.concatenate(words).astype(np.int64).view(np.uint64))
    first, end = np.repeat(np.cumsum(n) - n, n), np.repeat(np.cumsum(n), n)
    at, doc = np.arange(len(flat)), np.repeat(np.arange(len(n)), n)
    starts = (at + WORDS <= end) | (at == first)
    h = np.zeros(len(flat), np.uint64)
    for k in range(WORDS):
        inside = at + k < end
        h[inside] = mixed(h[inside] + flat[np.minimum(at + k, len(flat) - 1)][inside] + _U(k + 1))
    doc, h = doc[starts], h[starts]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
    begin = np.flatnonzero(new)
    return doc[begin], h[begin], np.diff(np.r_[begin, len(h)]).astype(float)


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int = REGISTERS) -> np.ndarray:
    """Signatures (n_docs x m): the element that first reached each register; 0 without elements.

    All elements make their first arrival, then those that can still matter their
    second, and so on, until every document's latest register is earlier than all.
    """
    best, winner = np.full(n_docs * m, np.inf), np.zeros(n_docs * m, np.uint64)
    time, turn = np.zeros(len(element)), 0
    while len(element):
        turn += 1
        draw = mixed(element + _U(turn * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log1p(-((draw >> _U(11)).astype(float) * 2.0**-53)) / weight
        cell = doc * m + (mixed(draw) % _U(m)).astype(np.int64)
        better = time < best[cell]
        np.minimum.at(best, cell[better], time[better])
        won = better & (time == best[cell])
        winner[cell[won]] = element[won]
        on = time < best.reshape(n_docs, m).max(axis=1)[doc]
        doc, element, weight, time = doc[on], element[on], weight[on], time[on]
    return winner.reshape(n_docs, m)


def similarity(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """The larger of probability Jaccard and plain Jaccard of two sorted weighted sets."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    plain = len(common) / (len(a) + len(b) - len(common))
    u, v = x[i], y[j]
    order = np.argsort(u / v, kind="stable")
    u, v = u[order], v[order]
    # with ratios ascending: where u/v of another is larger its u counts (relative to this u), else its v
    only_a, only_b = x.sum() - u.sum(), y.sum() - v.sum()
    above, upto = u.sum() - np.cumsum(u), np.cumsum(v)
    return max(plain, float((1 / ((above + only_a) / u + (upto + only_b) / v)).sum()))


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.hash(w))


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        doc, h, w = shingles(list(pdf["words"]))
        z = prob_minhash(doc, h, w, len(pdf))
        plain = z.copy()
        # without a repeated shingle both signatures are the same
        again = np.zeros(len(pdf), bool)
        again[doc[w > 1]] = True
        if again.any():
            of = again[doc]
            plain[again] = prob_minhash((np.cumsum(again) - 1)[doc[of]], h[of], np.ones(int(of.sum())), int(again.sum()))
        z = np.concatenate([z, plain], axis=1)
        packed = np.ascontiguousarray((z & _U(255)).astype(np.uint8)).view(np.int64)
        out = pd.DataFrame({"id": pdf["id"], "digest": pdf["digest"], "n_words": [len(x) for x in pdf["words"]]})
        for k in range(LONGS):
            out[f"s{k}"] = packed[:, k]
        yield out


SIGNED = "id long, digest struct<x:long,y:long>, n_words long, " + ", ".join(f"s{k} long" for k in range(LONGS))


def buckets_of() -> Column:
    """The distinct buckets of a signed row: the band's number, then its four registers (half a long), in one long."""
    each = LONGS // KINDS
    half = lambda k, band: F.shiftrightunsigned(F.col(f"s{k * each + band // 2}"), 32 * (band % 2)).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.array_distinct(F.array(*[half(k, band).bitwiseOR(F.lit(band << 32)) for k in range(KINDS) for band in range(BANDS)]))


def _agree(a: str, b: str) -> Column:
    """Registers that agree, in the signature where more do: equal bytes of the packed signatures."""
    differ = []
    for k in range(LONGS):
        x = F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))
        for by in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, by))
        differ.append(F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101))))
    each = LONGS // KINDS
    return F.lit(REGISTERS) - F.least(*[sum(differ[k + 1 : k + each], differ[k]) for k in range(0, LONGS, each)])


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        doc, h, w = shingles(list(pdf["words_a"]) + list(pdf["words_b"]))
        cut, n = np.searchsorted(doc, np.arange(2 * len(pdf) + 1)), len(pdf)
        part = lambda k: (h[cut[k] : cut[k + 1]], w[cut[k] : cut[k + 1]])
        s = np.array([similarity(*part(k), *part(n + k)) for k in range(n)])
        yield pdf[["a", "b"]][s >= SIMILARITY]


def verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough by their whole texts.  ``words``: see ``words_by_id``."""
    pairs = stage(pairs, "pairs")
    side = lambda x: words.select(F.col("id").alias(x), F.col("words").alias(f"words_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_verify, "a long, b long")


def words_by_id(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, words), bucketed by id: the word hashes of the text that stands for each of ``ids`` (bucketed by id).

    ``texts`` has id, digest and text.  This is the only shuffle of whole texts, as hashes of four bytes a word.
    """
    words = texts.select("id", F.struct("digest", word_hashes(F.col("text")).alias("words")).alias("row"))
    one = words.groupBy("id").agg(F.min("row").alias("row"))
    return stage_by(one.join(ids, "id", "left_semi").select("id", F.col("row.words").alias("words")), "id", "words")


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of two blocks of a bucket (or within one) whose classes differ, whose registers agree and that share no earlier band."""
    registers = lambda row, x: np.stack([getattr(row, f"{x}_s{k}") for k in range(LONGS)], axis=1).view(np.uint8)
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            a, b = registers(row, "a"), registers(row, "b")
            fit = row.a_class[:, None] != row.b_class[None, :]
            if row.x == row.y:
                fit = np.triu(fit, 1)
            i, j = np.nonzero(fit)
            # some pairs at a time, so that a pair of full blocks stays small in memory
            good = [np.zeros(0, bool)]
            for at in range(0, len(i), 16_384):
                same = a[i[at : at + 16_384]] == b[j[at : at + 16_384]]
                earlier = same.reshape(len(same), KINDS, BANDS, ROWS)[:, :, : row.band].all(axis=3).any(axis=(1, 2))
                good.append(~earlier & (same.reshape(len(same), KINDS, REGISTERS).sum(axis=2).max(axis=1) >= MIN_AGREE))
            good = np.concatenate(good)
            if good.any():
                out.append((row.bucket, row.x, row.y, row.a_id[i[good]], row.b_id[j[good]]))
        yield pd.DataFrame(out, columns=["bucket", "x", "y", "a", "b"])


def linked(n: int, doc: np.ndarray, h: np.ndarray, w: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of ``n`` documents, given as by ``shingles``, have a similarity of ``SIMILARITY`` or more.

    One document against all its partners at a time.  Plain Jaccard is exact; probability Jaccard has a
    bound first (the sum of maxima is at least the maximum of the sums) and is worked out where that allows a link.
    """
    cut = np.searchsorted(doc, np.arange(n + 1))
    mass = np.array([w[cut[k] : cut[k + 1]].sum() for k in range(n)])
    _, word = np.unique(h, return_inverse=True)
    held, good = np.zeros(len(h) + 1), np.zeros(len(i), bool)
    order = np.argsort(i, kind="stable")
    for mine in np.split(order, np.flatnonzero(np.diff(i[order])) + 1) if len(i) else []:
        k, others = i[mine[0]], j[mine]
        own = slice(cut[k], cut[k + 1])
        held[word[own]] = w[own]
        size = cut[others + 1] - cut[others]
        pair = np.repeat(np.arange(len(others)), size)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + cut[others][pair]
        u = held[word[at]]
        common = u > 0
        pair, u, v = pair[common], u[common], w[at[common]]
        total = lambda x: np.bincount(pair, x, len(others))  # noqa: B023, E731
        both, in_u, in_v = total(np.ones(len(u))), total(u), total(v)
        plain = both / (cut[k + 1] - cut[k] + size - both)
        only_u, only_v = mass[k] - in_u, mass[others] - in_v
        bound = total(1 / (only_u[pair] / u + only_v[pair] / v + np.maximum(in_u[pair] / u, in_v[pair] / v)))
        good[mine] = plain >= SIMILARITY
        for p in np.flatnonzero((plain < SIMILARITY) & (bound >= SIMILARITY - 1e-9)):
            o = slice(cut[others[p]], cut[others[p] + 1])
            good[mine[p]] = similarity(h[own], w[own], h[o], w[o]) >= SIMILARITY
        held[word[own]] = 0
    return good


def _verify_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for ids, words, a, b in zip(pdf["ids"], pdf["words"], pdf["a"], pdf["b"], strict=True):
            order = np.argsort(ids)
            place = lambda x: order[np.searchsorted(ids, x, sorter=order)]  # noqa: B023, E731
            good = linked(len(ids), *shingles(list(words)), place(a), place(b))
            yield pd.DataFrame({"a": a[good], "b": b[good]})


def across_classes(buckets: DataFrame, torn: DataFrame, label: DataFrame, sig: DataFrame, words: DataFrame) -> DataFrame:
    """The links (a, b) among all candidate pairs between two classes."""
    across = buckets.join(label, "id").join(torn, "bucket").join(sig, "id").withColumn("band", F.shiftright("bucket", 32).cast("int"))
    minor = F.col("class") != F.col("major")
    whole = (F.col("n_all") <= BLOCK) & (F.col("w_all") <= BLOCK_WORDS)
    parts = lambda n, w: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(w / BLOCK_WORDS))
    few = parts(F.col("n_all") - F.col("n_major"), F.col("w_all") - F.col("w_major"))
    dealt = lambda n: F.pmod(F.xxhash64("id"), n)
    block = F.when(whole, 0).when(minor, dealt(few)).otherwise(few + dealt(parts(F.col("n_major"), F.col("w_major"))))
    fields = ["id", "class", *(f"s{k}" for k in range(LONGS))]
    across = across.select("bucket", "band", block.alias("block"), whole.alias("whole"), (whole | minor).alias("minor"), *fields)
    blocks = across.groupBy("bucket", "band", "block", "whole", "minor").agg(F.collect_list(F.struct(*fields)).alias("of"))
    blocks = stage(blocks, "blocks")
    side = lambda x: [F.col(f"{x}.of.{c}").alias(f"{x}_{c}") for c in fields]
    both = lambda df: df.select("a.bucket", "a.band", F.col("a.block").alias("x"), F.col("b.block").alias("y"), *side("a"), *side("b"))
    # members of the largest class meet only others: their blocks come after all blocks of the rest
    one = blocks.where("minor")
    own = one.select("bucket", "band", F.col("block").alias("x"), F.col("block").alias("y"), *[F.col(f"of.{c}").alias(f"{x}_{c}") for x in "ab" for c in fields])
    two = both(one.where("not whole").alias("a").join(blocks.where("not whole").alias("b"), F.expr("a.bucket = b.bucket and a.block < b.block")))
    key = ["bucket", "x", "y"]
    cells = stage(own.union(two).mapInPandas(_candidates, "bucket long, x long, y long, a array<long>, b array<long>"), "cells")
    needs = stage(cells.select(*key, F.explode(F.array_distinct(F.concat("a", "b"))).alias("id")), "needs")
    filled = needs.join(words, "id").groupBy(*key).agg(F.collect_list(F.struct("id", "words")).alias("of"))
    return cells.join(filled, key).select(F.col("of.id").alias("ids"), F.col("of.words").alias("words"), "a", "b").mapInPandas(_verify_cells, "a long, b long")


def components(ids: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """(id, class): the smallest id in the connected component, for every linked id.

    Each round gives every node the smallest label among itself and its neighbours and
    then that label's own label (pointer jumping); each is a written table.  A link
    between nodes of the same label is dropped, so the rounds shrink.
    """
    label = stage(ids.select("id", F.col("id").alias("class")), f"{name}-labels")
    live = stage(links.select("a", "b").where("a <> b"), f"{name}-links")
    while not live.isEmpty():
        # hook: the larger of two classes points at the smallest class it is linked to
        hook = live.select(F.greatest("a", "b").alias("class"), F.least("a", "b").alias("to")).groupBy("class").agg(F.min("to").alias("to"))
        hook = stage(hook, f"{name}-hook")
        while True:
            up = hook.select(F.col("class").alias("to"), F.col("to").alias("to2"))
            jumped = stage(hook.join(up, "to", "left").select("class", F.coalesce("to2", "to").alias("to"), F.col("to2").isNotNull().alias("moved")), f"{name}-jump")
            hook = jumped.select("class", "to")
            if jumped.where("moved").isEmpty():
                break
        label = stage(label.join(hook, "class", "left").select("id", F.coalesce("to", "class").alias("class")), f"{name}-labels")
        at = lambda x: hook.select(F.col("class").alias(x), F.col("to").alias(f"to_{x}"))
        live = live.join(at("a"), "a", "left").join(at("b"), "b", "left").select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
        live = stage(live.where("a <> b").distinct(), f"{name}-links")
    return label


def classes(signed: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, class) of every signed document that shares a bucket.

    ``signed`` has one row an id and is bucketed by it (see ``SIGNED``); ``texts`` as in ``words_by_id``.
    """
    every = signed.select("id", F.explode(buckets_of()).alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = stage_by(every.join(shared, "bucket"), "id", "buckets")
    members = stage_by(buckets.select("id").distinct(), "id", "members")
    words = words_by_id(texts, members)
    sig = signed.drop("n_words")
    label = stage(members.join(signed.select("id", "n_words"), "id").withColumn("class", F.col("id")), "member-labels")
    agreeing = lambda pairs: pairs.alias("p").join(sig.alias("a"), F.col("p.a") == F.col("a.id")).join(sig.alias("b"), F.col("p.b") == F.col("b.id")).withColumn("agree", _agree("a", "b")).where(F.col("agree") >= MIN_AGREE)
    for turn in range(ROUNDS):
        torn = torn_buckets(buckets, label, turn)
        beside = buckets.join(label, "id").join(torn.select("bucket", "major", "leader"), "bucket").where("class <> major")
        pairs = agreeing(beside.select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct())
        nearest = pairs.groupBy(F.col("p.a").alias("a")).agg(F.max_by("p.b", F.struct("agree", "p.b")).alias("b"))
        label = merged(label, verified(nearest, words), f"round-{turn}")
    torn = torn_buckets(buckets, label, ROUNDS)
    label = merged(label, across_classes(buckets, torn, label, sig, words), "rest")
    forget(buckets, members, words)
    return label


def torn_buckets(buckets: DataFrame, label: DataFrame, turn: int) -> DataFrame:
    """Buckets with members of several classes: the largest class, one member of it (another each turn), documents and words."""
    some = F.max(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id")).alias("some")
    inside = buckets.join(label, "id").groupBy("bucket", "class").agg(F.count("*").alias("n"), F.sum("n_words").alias("w"), some)
    top = F.max(F.struct("n", "class", "w", "some")).alias("top")
    torn = inside.groupBy("bucket").agg(F.count("*").alias("classes"), F.sum("n").alias("n_all"), F.sum("w").alias("w_all"), top).where("classes > 1")
    named = {"major": "top.class", "leader": "top.some.id", "n_major": "top.n", "w_major": "top.w"}
    return stage(torn.select("bucket", "n_all", "w_all", *[F.col(at).alias(to) for to, at in named.items()]), f"torn-{turn}")


def merged(label: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """``label`` after uniting the classes that ``links`` connect."""
    united = components(label.select(F.col("class").alias("id")).distinct(), classes_of(links, label), name)
    return stage(label.join(united.select(F.col("id").alias("class"), F.col("class").alias("to")), "class").select("id", "n_words", F.col("to").alias("class")), f"{name}-merged")


def classes_of(links: DataFrame, label: DataFrame) -> DataFrame:
    at = lambda x: label.select(F.col("id").alias(x), F.col("class").alias(f"class_{x}"))
    return links.join(at("a"), "a").join(at("b"), "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id): one row per doc_id; ``class_id`` is the smallest doc_id of its class."""
    python_tasks(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.struct(F.xxhash64("text").alias("x"), F.xxhash64(F.lit(1), "text").alias("y")).alias("digest")
    keyed = rows.where("doc_id is not null").select("doc_id", digest).groupBy("doc_id").agg(F.min("digest").alias("digest"))
    keyed = stage(keyed, "digests")
    chosen = stage(keyed.groupBy("digest").agg(F.min("doc_id").alias("id")), "chosen")
    # signed before any shuffle, so that no text moves; of a doc_id the text that stands for it stays, and one id of equal texts
    known = rows.where("doc_id is not null").select(F.col("doc_id").alias("id"), digest, "text")
    signed = known.select("id", "digest", word_hashes(F.col("text")).alias("words")).mapInPandas(_sign, SIGNED)
    one = signed.groupBy("id").agg(F.min(F.struct(*signed.columns[1:])).alias("row")).where("row.n_words > 0")
    signed = stage_by(one.join(chosen.select("id"), "id", "left_semi").select("id", "row.n_words", *[f"row.s{k}" for k in range(LONGS)]), "id", "signed")
    label = classes(signed, known)
    forget(signed)
    final = label.select("id", F.col("class").alias("class_id"))
    same = keyed.join(chosen, "digest").select("doc_id", "id")
    none = rows.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id")).limit(1)
    return same.join(final, "id", "left").select("doc_id", F.coalesce("class_id", "id").alias("class_id")).union(none)


def op10(docs: DataFrame) -> DataFrame:
    """The registered query."""
    return near_duplicates(docs)
