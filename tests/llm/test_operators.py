"""Edge rows and empty tables through every operator; results against plain versions."""
import collections
import gc
import hashlib
import math
import re
import tracemalloc
import zlib
from array import array

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roamkit.llm import bpe, neardup, packing, quality, search, secret_scan, sharding, tokens, toxicity, warc, wavelet

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def test_empty_tables(spark, edges, labels):
    none = edges.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (secret_scan.op1(none), warc.op2(pages), wavelet.op3(none, WORD), bpe.op4(none, WORD), packing.op5(none, BYTE), toxicity.op6(none, labels.limit(0)),
               search.op7(none), sharding.op8(none), quality.op9(none), neardup.op10(none)):
        assert df.collect() == []


def test_secrets(spark, edges):
    found = rows_of(secret_scan.op1(edges))
    assert [(r["doc_id"], r["candidate"], r["start"], r["is_secret"]) for r in found if "ab12" in r["candidate"]] == [(None, "ab12cd34ef56ab78", 20, True)]
    clean = secret_scan.masked(edges, secret_scan.scan(edges))
    assert clean.columns == edges.columns and clean.count() == edges.count()
    assert clean.where("doc_id is null").first()["text"] == "no id but password=[SECRET] in it"


def test_candidates_have_their_places(spark):
    """Short and mixed passwords, logins, runs; a run inside a longer one is none of its own; texts of many candidates."""
    texts = ['password=hunter2 and "pwd": "S3cr3t!pass@2024"; go', "see https://user:pa55w0rd@host/x", "abcd1234efgh5678ZZZZ then abcd1234efgh5678 \x01 é abcd1234efgh5678", "mail bob:onlyletters@host; token: letters",
             " ".join(f"key{k}x9 w" for k in range(10_000, 11_000)), "", None, "nothing here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    got = collections.defaultdict(list)
    for r in secret_scan.findings(docs).collect():
        got[r["doc_id"]].append((r["start"], r["candidate"]))
        text = texts[r["doc_id"]]
        assert text[r["start"] - 1 :].startswith(r["candidate"])
        assert (r["before"] or r["start"] == 1) and (r["after"] or text.endswith(r["candidate"]))
        assert text[: r["start"] - 1].endswith(r["before"]) or "\x01" in text
        assert text[r["start"] - 1 + len(r["candidate"]) :].startswith(r["after"]) or "\x01" in text
    assert sorted(got[0]) == [(10, "hunter2"), (30, "S3cr3t!pass@2024")]
    assert got[1] == [(18, "pa55w0rd")] and sorted(got[3]) == [(10, "onlyletters"), (35, "letters")]
    assert sorted(got[2]) == [(1, "abcd1234efgh5678ZZZZ"), (27, "abcd1234efgh5678"), (48, "abcd1234efgh5678")]
    assert sorted(got[4]) == [(m.start() + 1, m.group()) for m in re.finditer(r"key\d+x9", texts[4])]
    assert set(got) == {0, 1, 2, 3, 4}
    every = secret_scan.judged(secret_scan.featured(secret_scan.findings(docs)), None)
    clean = {r["doc_id"]: r["text"] for r in secret_scan.masked(docs.withColumn("places", F.lit(1)), every).collect()}
    assert clean[0] == 'password=[SECRET] and "pwd": "[SECRET]"; go' and clean[1] == "see https://user:[SECRET]@host/x"
    assert clean[2] == "[SECRET] then [SECRET] \x01 é [SECRET]" and clean[6] is None and clean[7] == "nothing here"


def test_forest_tells_findings_apart(spark):
    rng = np.random.default_rng(0)
    texts = []
    for k in range(400):
        text = f'a token = "{rng.bytes(20).hex()}" b' if k % 2 else f"order {rng.integers(10**15, 10**16)} was sent"
        texts.append((k, text, "src"))
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    known = secret_scan.labelled(secret_scan.featured(secret_scan.findings(docs.where("doc_id < 200"))))
    got = rows_of(secret_scan.scan(docs.where("doc_id >= 200"), known=known))
    assert len(got) == 200 and all(r["is_secret"] == (r["doc_id"] % 2 == 1) for r in got)


def test_warc(spark):
    big = "x" * 120
    rows = [(1, "http://b.Example.com/p", big), (2, "http://a.example.com/", big), (2, "http://a.example.com/", big), (3, None, None), (4, "x y\n", "short"), (5, "", "short"), (None, "http://b.example.com/p", big), (6, "http://b.example.com/p", "é" * 60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("z")).withColumn("digest", F.lit("z"))
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows_of(warc.op2(pages)))
    body = lambda h: (h or "").encode()
    want = sorted((str(p), len(body(h)), hashlib.sha256(body(h)).hexdigest(), *(("revisit", 1) if p == 2 else ("response", None))) for p, _, h in rows)
    assert got == want
    assert [r[0] for r in pages.limit(2).select(warc.url_key(F.col("url"))).collect()] == ["com,example,b)/p", "com,example,a)/"]


def test_index_blocks(spark, monkeypatch):
    from pyarrow import fs
    captures = warc.CaptureIndex.__new__(warc.CaptureIndex)
    lines = [(f"k{n:03d}", n, "f", n, 1) for n in range(50) for _ in range(3)]
    blocks = [lines[k:k + 7] for k in range(0, len(lines), 7)]
    captures.files, captures.first, captures.store = [(lines[0][0], 0, "p")], [lines[0][:2]], fs.LocalFileSystem()
    monkeypatch.setattr(captures, "directory", lambda k: ([b[0][:2] for b in blocks], blocks), raising=False)
    monkeypatch.setattr(captures, "lines", lambda k, b: ([r[:2] for r in blocks[b]], blocks[b]), raising=False)
    assert all(len(list(captures.find(f"k{n:03d}", n))) == 3 for n in range(50)) and not list(captures.find("k007", 8))


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 49408, 5000)
    ids[::7] = 9
    _, _, m = wavelet.from_bytes(wavelet.to_bytes([None], np.array([5000]), ids))
    assert (m.tokens() == ids).all() and [m.access(k) for k in range(0, 5000, 211)] == ids[::211].tolist()
    assert all(m.rank(9, k) == (ids[:k] == 9).sum() for k in (0, 1, 8, 4999, 5000)) and m.rank(65536, 9) == 0
    places = np.flatnonzero(ids == 9)
    assert [m.select(9, k) for k in range(0, len(places), 50)] == places[::50].tolist()
    with pytest.raises(IndexError):
        m.select(9, len(places))


def test_wavelet_files(edges):
    got = rows_of(wavelet.op3(edges, WORD))
    encode, by_id = library(WORD).encode, collections.defaultdict(list)
    for r in edges.collect():
        ids = encode(r["text"] or "", add_special_tokens=False).ids + [1]
        by_id[r["doc_id"]].append((len(ids), zlib.crc32(array("I", ids).tobytes())))
    have = collections.defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in by_id.items()}
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


ODD = ["", "a", "  a  b\n\n c ", "x\t y", "\x1c a\x1fb", "ΑΣ ΣΑΣ σ", "<|endoftext|>a <|startoftext|> B", "İstanbul é é", "漢字 123 ٣", "it's I'LL we'Ve 's", "a\x00b \x00", " x  y\x85z\xa0q", "ﬁ Å ½ x²", "... !!! a.b,c 12345", "\n", "qzxjk vvqqz"]


def test_encoders_equal_the_library(edges):
    texts = ODD + [r["text"] or "" for r in edges.collect()]
    for path in (WORD, BYTE):
        assert [list(array("I", x)) for x in tokens.encoder(path).encode(texts)] == [e.ids for e in library(path).encode_batch(texts, add_special_tokens=False)]
    lib, own = library(WORD), bpe.codec(WORD)
    for t in texts:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids
        assert own.round_trip(t) == (len(ids), " ".join(map(str, ids)).encode(), lib.decode(ids, skip_special_tokens=False).encode())


def test_cuts_are_safe():
    own = bpe.codec(WORD)
    for word in ("qzxjkvvqqz", "straße", "naïveté", "xqjwzkv", "thebestwordever"):
        symbols = [own.char_of[b] for b in word.encode()]
        symbols[-1] += own.suffix
        assert own.word_ids(word) == list(own.merge(tuple(symbols)))


def test_bpe_rows(edges):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(bpe.op4(edges, WORD)))
    lib, want = library(WORD), []
    for r in edges.collect():
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)


def best_fit(lengths, room):
    """Best fit decreasing, a piece at a time."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k in range(len(left)) if left[k] >= n]
        if fits:
            left[min(fits, key=lambda k: left[k])] -= n
        else:
            left.append(room - n)
    return sorted(left)


def test_plan_is_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 40, 200).tolist() + [40] * 3 + [7] * 50
        counts = collections.Counter(lengths)
        used, places = collections.Counter(), collections.defaultdict(list)
        for length, first, last, sequence, each, at in packing.plan(counts, 40):
            for rank in range(first, last):
                s = sequence + (rank - first) // each
                used[s] += length
                places[s].append((at + (rank - first) % each * length, length))
        assert sorted(40 - u for u in used.values()) == best_fit(lengths, 40)
        for p in places.values():
            assert [a for a, _ in sorted(p)] == [0, *np.cumsum([n for _, n in sorted(p)])[:-1]]


def test_packing_rows(edges):
    from roamkit.llm.shared import stage
    cut = stage(packing.pieces(edges, BYTE, 2), "test-pieces")
    got = rows_of(packing.pack(cut))
    assert len(got) == cut.count() and all(1 <= r["length"] <= 1024 for r in got)
    joined = {r["sequence_id"]: r["ids"] for r in packing.sequences(cut, packing.pack(cut)).collect()}
    by = collections.defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by[r["sequence_id"]]
        by[r["sequence_id"]] += r["length"]
        part = bytes(joined[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])])
        assert zlib.crc32(part) == r["ids_crc32"]
    assert max(by.values()) <= 1024


def test_toxicity(spark, edges, labels):
    got = rows_of(toxicity.op6(edges, labels))
    assert len(got) == edges.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_machine_learns_pairs():
    """Neither term alone is toxic, both together are: the linear part can't tell."""
    docs = [[0], [1], [0, 1], []] * 50
    label = np.array([0.0, 0, 1, 0] * 50)
    scores = toxicity.fit(docs, label, np.array([11, 22])).scores(docs[:4])
    assert scores[2] > 0.9 and max(scores[[0, 1, 3]]) < 0.1


def test_held_out_accuracy(spark):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 500, 60)) + (" idiot" if k % 5 == 0 else "")) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k, _ in rows], "doc_id long, toxic int")
    got = [r for r in rows_of(toxicity.op6(docs, labels)) if r["held_out"]]
    assert len(got) > 300 and all(r["predicted"] == (r["doc_id"] % 5 == 0) for r in got)


def test_thinned_classes_keep_their_share(spark):
    """A tenth is toxic; a sample of equal classes must not move the scores to a half."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same plain words").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, size=100)
    assert 0.05 < model.scores([[]])[0] < 0.2
    sampled, label, counts = [[0], [1]] * 50 + [[0]] * 100, np.r_[np.ones(100), np.zeros(100)], np.r_[np.ones(100), np.full(100, 9.0)]
    natural = toxicity.fit(sampled + [[0]] * 800, np.r_[label, np.zeros(800)], np.array([11, 22]))
    assert np.allclose(toxicity.fit(sampled, label, np.array([11, 22]), counts=counts).scores([[0], [1], []]), natural.scores([[0], [1], []]), atol=0.01)


def test_scoring_keeps_nothing_of_earlier_models(spark):
    """A worker outlives many models; what a task keeps of its texts is freed with the task."""
    class Docs:
        sparkSession = spark
        select = lambda self, *_: self
        mapInPandas = lambda self, work, _: work

    pdf = pd.DataFrame({"doc_id": range(100), "text": [" ".join(f"w{k}x{i}" for i in range(200)) for k in range(100)]})

    def scored(k):
        model = toxicity.FactorizationMachine(np.arange(k, k + 3), 0.0, np.zeros(3), np.zeros((3, toxicity.FACTORS)))
        return sum(len(x) for x in toxicity.score(Docs(), model)(iter([pdf])))

    tracemalloc.start()
    try:
        assert scored(0) == 100
        gc.collect()
        before = tracemalloc.get_traced_memory()[0]
        for k in range(1, 4):
            scored(k)
        gc.collect()
        assert tracemalloc.get_traced_memory()[0] - before < 500_000
    finally:
        tracemalloc.stop()


def test_kept_chunks_are_few_and_short(monkeypatch):
    texts = ["short words and " + "long" * 100, "other short words", "long" * 100]
    place = {t: k for k, t in enumerate(sorted(toxicity.terms(" ".join(texts))))}
    plain = [sorted(place[t] for t in toxicity.terms(x)) for x in texts]
    seen = {}
    assert toxicity.places(texts, place, seen) == toxicity.places(texts, place, seen) == plain
    assert set(seen) == {"short", "words", "and", "other"}
    monkeypatch.setattr(toxicity, "KEPT", 2)
    assert toxicity.places(texts, place, few := {}) == plain and len(few) == 2


def test_search_against_brute_force(spark, edges):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 40) if x < 3000)) for k in range(500)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in search.op7(docs).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["doc_id"], r["score"]))
    term = {k: collections.Counter(re.findall(r"[a-z0-9]+", t or "")) for k, t in rows}
    df, n = collections.Counter(w for c in term.values() for w in c), len(rows)
    mean = sum(sum(c.values()) for c in term.values()) / n
    for q in range(0, 500, 50):
        score = {k: sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w in term[q] if w in c) for k, c in term.items()}
        want = sorted(((-round(s, 6), k) for k, s in score.items() if s > 0))[:10]
        assert [k for k, _ in got[q]] == [k for _, k in want] and np.allclose([s for _, s in got[q]], [-s for s, _ in want], atol=2e-6)
    assert 900 not in got
    assert search.search(edges, edges.select(F.col("doc_id").alias("query_id"), "text").where("doc_id = 1")).count() > 0


def test_pruned_search_is_exact():
    """Common and rare terms, many equal documents, files searched as one: any threshold up to the k-th score gives the k best."""
    rng = np.random.default_rng(6)
    lists = [sorted(int(x) for x in rng.zipf(1.3, 60) if x < 4000) for _ in range(3000)]
    lists += [lists[7]] * 40
    files = []
    for part in (lists[:1000], lists[1000:]):
        term, count = zip(*(np.unique(np.array(x, np.int64), return_counts=True) for x in part), strict=True)
        doc, term, count = np.repeat(np.arange(len(part), dtype=np.int32), [len(t) for t in term]), np.concatenate(term), np.concatenate(count)
        order = np.argsort(term, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0])
        ids = np.arange(len(part), dtype=np.int64) + 1000 * len(files)
        files.append({"doc_id": ids, "length": np.array([len(x) for x in part], np.int32), "term": term[order][first], "start": np.r_[first, len(term)], "doc": doc[order], "count": count[order].astype(np.int32)})
    shard = search.Shard(files, 50.0)
    df = np.diff(shard.start)
    for q in (0, 7, 1500, 2999):
        terms = np.unique(np.array(lists[q], np.int64))
        idf = np.log1p((3040 - df + 0.5) / (df + 0.5))[np.searchsorted(shard.term, terms)]
        full = np.zeros(3040)
        for t, w in zip(np.searchsorted(shard.term, terms), idf, strict=True):
            full += w * shard.look_up(t, np.arange(3040))
        full = np.round(full, search.DIGITS)
        want = np.lexsort((np.arange(3040), -full))[:10]
        seeds = shard.seeds(terms, idf, 10)
        assert len(seeds) == 10 and seeds[-1] <= full[want[-1]]
        for least in (-1.0, seeds[-1], full[want[-1]]):
            docs, scores = shard.search(terms, idf, 10, least)
            assert docs.tolist() == want.tolist() and np.allclose(scores, full[want], atol=2e-6)


def test_common_terms_are_not_walked(monkeypatch):
    """Lists that many documents hold are multiplied as a matrix for a batch of queries; equal documents beyond the postings scored at once all count."""
    rng = np.random.default_rng(8)
    lists = [np.unique(np.r_[rng.integers(0, 40, 30), rng.integers(40, 20000, 20)]) for _ in range(2000)]
    lists += [lists[3]] * 300
    doc, term = np.repeat(np.arange(2300, dtype=np.int32), [len(x) for x in lists]), np.concatenate(lists)
    order = np.argsort(term, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0])
    file = {"doc_id": np.arange(2300)[::-1].copy(), "length": np.array([len(x) for x in lists], np.int32), "term": term[order][first], "start": np.r_[first, len(term)], "doc": doc[order], "count": rng.integers(1, 4, len(term)).astype(np.int32)}
    file["count"][np.isin(file["doc"], [3, *range(2000, 2300)])] = 1
    shard = search.Shard([file], 30.0)
    df = np.diff(shard.start)
    asked = [(lists[q], np.log1p((2300 - df + 0.5) / (df + 0.5))[np.searchsorted(shard.term, lists[q])]) for q in (0, 3, 700, 1999)]
    want = []
    for terms, idf in asked:
        full = np.round(sum(w * shard.look_up(t, np.arange(2300)) for t, w in zip(np.searchsorted(shard.term, terms), idf, strict=True)), search.DIGITS)
        best = np.lexsort((shard.doc_id, -full))[:10]
        want.append((best.tolist(), full[best]))
    seen, walk, look_up = [], search.Shard.walk, search.Shard.look_up
    monkeypatch.setattr(search, "SCORES", 5000, raising=False)
    monkeypatch.setattr(search.Shard, "walk", lambda self, at, idf, n: seen.append(n.sum()) or walk(self, at, idf, n))
    monkeypatch.setattr(search.Shard, "look_up", lambda self, t, docs: seen.append(len(docs)) or look_up(self, t, docs))
    for (terms, idf), (docs, scores) in zip(asked, want, strict=True):
        seen.clear()
        got = shard.search(terms, idf, 10)
        assert got[0].tolist() == docs and np.allclose(got[1], scores, atol=2e-6)
        assert sum(seen) < 0.05 * df[np.searchsorted(shard.term, terms)].sum()
    got = list(shard.search_all([(terms, idf, scores[-1]) for (terms, idf), (_, scores) in zip(asked, want, strict=True)], 10))
    assert [docs.tolist() for docs, _ in got] == [docs for docs, _ in want]


def test_many_shards_and_blocks_find_what_one_finds(spark, monkeypatch):
    """Thresholds come from one of ``LEAD`` shards, and each shard is searched for all blocks of queries."""
    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 50) if x < 2000) for _ in range(600)]
    rows = [(k if k % 97 else None, texts[k % 40] if k % 3 == 0 else texts[k]) for k in range(600)] + [(700, None), (750, ""), (50, "w1 w2 w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).persist()
    asked = docs.where("doc_id % 5 = 0").select(F.col("doc_id").alias("query_id"), "text")

    def found():
        return [tuple(r) for r in search.search(docs, asked, 10).orderBy("query_id", "rank").collect()]

    want = found()
    assert len({r[0] for r in want}) > 100
    passes, each_shard = [], search.each_shard
    with monkeypatch.context() as m:
        m.setattr(search, "SHARD_POSTINGS", 700)
        m.setattr(search, "QUERY_TERMS", 500)
        m.setattr(search, "each_shard", lambda groups, blocks, *rest: passes.append((groups.count(), blocks.count())) or each_shard(groups, blocks, *rest))
        got = found()
    (lead, blocks), (shards, _) = passes
    assert 1 <= lead <= shards / 4 and blocks > 1
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=2e-6)


def test_shards(edges, spark):
    got = rows_of(sharding.op8(edges))
    assert len(got) == edges.count() and all(r["size"] >= 1 for r in got)
    by = collections.defaultdict(list)
    for r in rows_of(sharding.op8(spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 90).cast("int")).alias("text")))):
        by[r["shard"]].append((r["slot"], r["size"]))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values())
    full = [sum(n for _, n in v) for v in by.values()]
    assert max(full) - min(full) <= 0.01 * max(full)


def test_map_versions(spark):
    sizes = {s: 100 + s % 37 for s in range(512)}
    one = sharding.balance(sizes, 16, 512)
    two = sharding.rebalance(one, sizes, 17)
    moved = [s for s in range(512) if one.shards[s] != two.shards[s]]
    load = collections.Counter()
    for s, k in enumerate(two.shards):
        load[k] += sizes[s]
    assert two.version == 2 and len(moved) < 512 / 17 * 1.5 and max(load.values()) < 1.05 * sum(sizes.values()) / 17
    assert len(set(sharding.rebalance(two, sizes, 8).shards)) == 8


def repeated(words):
    at, covered = collections.defaultdict(list), set()
    for k in range(len(words) - 7):
        at[tuple(words[k:k + 8])].append(k)
    for v in at.values():
        if len(v) > 1:
            covered.update(x for k in v for x in range(k, k + 8))
    return len(covered)


def test_quality_counts_and_outliers(spark, edges):
    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated(words)
    keys = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgé"), rng.integers(2, 8)))
    texts = [" ".join(word() for _ in range(rng.integers(30, 200))) for _ in range(300)]
    texts += ["\n".join(["a b c d e f g h i j", "x #|", "a b c d e f g h i j", " "] * 3), "WORD%%% " * 40 + " ".join(word().upper() + "$$$" for _ in range(60))]
    docs = edges.select("doc_id", "text", "lang", "source").union(spark.createDataFrame([(100 + k, t, "en", "a") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string"))
    got = collections.defaultdict(list)
    for r in rows_of(quality.op9(docs)):
        got[r["doc_id"]].append(r)
    for r in docs.collect():
        n, *rest = plain(r["text"])
        g = got[r["doc_id"]][0]
        assert tuple(g[k] for k in keys) == (n, *rest)
        assert g["base_failed"] == (n < 20 or 100 * rest[-1] > 30 * n) and not (g["base_failed"] and g["kept"])
    assert all(got[100 + k][0]["kept"] for k in range(300)) and not got[401][0]["kept"]


def test_menu_junk_is_an_outlier(spark):
    """A pipe after every third word: its squared distance (23.4) is over the 0.999 quantile and under that of 1 - 1e-6."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abcdefgé"), rng.integers(2, 8)))
    texts = [" ".join(word() for _ in range(rng.integers(30, 200))) for _ in range(400)]
    texts.append(" ".join(word() + (" |" if k % 3 == 0 else "") for k in range(80)))
    docs = spark.createDataFrame([(k, t, "en", "a") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert [r["doc_id"] for r in rows_of(quality.op9(docs)) if not r["kept"]] == [400]


def test_rare_languages_are_judged(spark):
    """Languages too small for an estimate of their own, and NULL, are judged by that of all rows."""
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgé"), rng.integers(2, 8)))
    text = lambda: " ".join(word() for _ in range(rng.integers(30, 200)))
    rows = [(k, text(), "en" if k < 300 else ("fr", "de", None)[k % 3]) for k in range(330)]
    rows += [(k, " ".join(word().upper() + "$$$" for _ in range(60)), lang) for k, lang in ((400, "fr"), (401, "xx"), (402, None))]
    docs = spark.createDataFrame([(*r, "a") for r in rows], "doc_id long, text string, lang string, source string")
    got = rows_of(quality.op9(docs))
    assert all(r["d2"] is not None for r in got) and {r["doc_id"] for r in got if not r["kept"]} == {400, 401, 402}
    few = docs.where("lang = 'fr'")  # fewer rows in all than MIN_ROWS
    assert [r["doc_id"] for r in rows_of(quality.op9(few)) if not r["kept"]] == [400]


def test_registers_estimate_probability_jaccard():
    a = np.arange(1, 301, dtype=np.uint64)
    x, y = np.ones(300), np.r_[np.ones(240), np.full(60, 3.0)]
    z = neardup.prob_minhash(np.repeat([0, 1], 300), neardup.mixed(np.r_[a, a]), np.r_[x, y], 2, m=8192)
    ratio = np.maximum(x[None] / x[:, None], y[None] / y[:, None]).sum(1)
    want = (1 / ratio).sum()
    assert abs((z[0] == z[1]).mean() - want) < 0.02
    plain = 1.0  # the same distinct shingles
    assert neardup.similarity(a, x, a, y) == plain and abs(neardup.similarity(a[:150], x[:150], a[100:250], x[100:250]) - 50 / 250) < 1e-9


def test_links_of_a_block():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 10**6, 150)
    words = []
    for k in range(40):
        own = np.r_[base, np.repeat(base[:10], k % 4 * 20)] if k % 3 else base.copy()
        own[rng.integers(0, len(own), k % 7)] = k
        words.append(own)
    words.append(base[:0])
    doc, h, w = neardup.shingles(words)
    part = lambda k: (h[doc == k], w[doc == k])
    i, j = np.triu_indices(len(words), 1)
    got = neardup.linked(len(words), doc, h, w, i, j)
    want = [neardup.similarity(*part(a), *part(b)) >= neardup.SIMILARITY for a, b in zip(i, j)]
    assert got.tolist() == want and 0 < sum(want) < len(want)


@pytest.mark.parametrize("rounds, block", [(4, 256), (0, 3)])
def test_classes_against_brute_force(spark, edges, monkeypatch, rounds, block):
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = np.random.default_rng(6)
    texts = []
    for g in range(30):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for _ in range(int(rng.integers(1, 12))):
            words = list(base)
            for k in rng.integers(0, 120, rng.integers(0, 4)):
                words[k] = f"n{rng.integers(0, 10**6)}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.op10(docs).collect()}
    shingles = [{tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for t in texts]
    parent = list(range(len(texts)))
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(texts)):
        for b in range(a):
            if len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b]) >= 0.8:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {k: root(k) for k in range(len(texts))}
    edge = {r["doc_id"]: r["class_id"] for r in neardup.op10(edges).collect()}
    assert edge == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8, None: None}


@pytest.mark.parametrize("rounds", [4, 0])
def test_copies_whose_footer_repeats_unequally(spark, monkeypatch, rounds):
    """Plain Jaccard is over 0.8 and probability Jaccard far under it: candidates must come from unit weights too."""
    monkeypatch.setattr(neardup, "ROUNDS", rounds)
    rng = np.random.default_rng(10)
    texts = []
    for g in range(8):
        base, footer = [f"w{x}" for x in rng.integers(0, 10**6, 150)], [f"f{g}x{x}" for x in range(10)]
        texts += [" ".join(base + footer), " ".join(base + footer * 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in neardup.op10(docs).collect()} == {k: k - k % 2 for k in range(16)}


def test_pipeline(spark, edges, labels, tmp_path):
    import corpus_pipeline as p
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = edges
    for name, step in p.STAGES[:4]:
        docs = step(spark, docs, str(tmp_path)).cache()
        assert docs.columns == edges.columns
    kept = [r["doc_id"] for r in docs.collect()]
    assert len(kept) == len(set(kept))
    assert {r["doc_id"] for r in p.STAGES[4][1](spark, docs, str(tmp_path)).select("doc_id").collect()} == set(kept)


def test_chunk_table_is_bounded_and_ids_stay(monkeypatch):
    """A full table gives the same ids, and keeps nothing of the batch that would overfill it."""
    import public_tokenizers

    from roamkit.llm import tokens
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["one two, three", "two four", "", "x\ty  z.", "four five"]
    free, full = tokens.Encoder(path), tokens.Encoder(path)
    want = free.encode(texts)
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 3)
    assert [full.encode([t])[0] for t in texts] == want == full.encode(texts)
    assert set(full.kept) == {"one", "two,", "three"}


def test_files_of_planes_are_run_length_streams():
    """Parts are plain zlib streams, no larger than those with a search for matches."""
    import zlib

    import numpy as np

    from roamkit.llm import wavelet
    ids = np.random.default_rng(1).zipf(1.3, 60_000) % 49_000
    data = wavelet.to_bytes([1], np.array([len(ids)]), ids)
    assert (wavelet.from_bytes(data)[2].tokens() == ids).all()
    planes = wavelet.WaveletMatrix.build(ids).planes
    assert sum(len(wavelet.compressed(p.tobytes())) for p in planes) < sum(len(zlib.compress(p.tobytes(), 1)) for p in planes)


def test_rejected_keys_are_broadcast_by_their_written_size(spark):
    """However low Spark's own threshold, texts aren't shuffled to drop a few keys."""
    import corpus_pipeline
    docs = spark.createDataFrame([(i, f"text {i}", "en", "web") for i in range(40)] + [(None, None, None, None)], "doc_id long, text string, lang string, source string")
    keys = docs.where("doc_id % 2 = 0").select(corpus_pipeline.row_key(docs).alias("doc_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        left = corpus_pipeline.without(docs, keys, "some")
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([*range(1, 40, 2), None], key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
