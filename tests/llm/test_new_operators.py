"""Treap search, tournament packing and the Merkle climb against plain versions, edge rows and empty tables."""
import collections
import hashlib
import math
import random
import re
import string
import zlib
from array import array

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roamkit.llm import bpe, ffd, merkle, oracles, secret_scan, sharding, treap

BYTE = public_tokenizers.path("byte_bpe_50k.json")
TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_search(docs, items, k=10):
    """(item, rank, doc_id, score) of every item, by scoring every document."""
    words = lambda t: [w.translate(LOWER) for w in TERMS.findall(t or "")]
    rows = [(d, collections.Counter(words(t))) for d, t in docs]
    rows = [(d, c) for d, c in rows if c]
    n, total = len(rows), sum(c.total() for _, c in rows)
    df = collections.Counter(w for _, c in rows for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in rows:
            m = 10 + 90 * c.total() * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(words(text)) if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def same(got, want):
    return sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_terms_are_those_of_the_pattern(spark):
    texts = ["", "A-b c", "Ünï ÀB's_x", "漢字 Ǆ\x00İ", "\x7f~a\xa0b" * 3, "0/9:@Z[`z{", " x " * 50]
    assert [[w.decode() for w in treap.terms_of(t)] for t in texts] == [[w.translate(LOWER) for w in TERMS.findall(t)] for t in texts]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(99, None)], "doc_id long, text string")
    assert treap.totals(docs) == (sum(bool(TERMS.findall(t)) for t in texts), sum(len(TERMS.findall(t)) for t in texts))


@pytest.mark.parametrize("seed", range(4))
def test_treap_gives_each_point(seed, monkeypatch):
    """Descending for single terms finds exactly the points of their rows; sums of terms are those of a plain matrix."""
    rng = np.random.default_rng(seed)
    grid = rng.integers(1, 1000, (37, 90)) * (rng.random((37, 90)) < (0.02, 0.2, 0.9, 0.001)[seed])
    grid[5, 3] = 7
    row, doc = np.nonzero(grid)
    t = treap.Treap(treap.Treap.build(row, doc, grid[row, doc]))
    ids = rng.permutation(90)
    if seed % 2:
        monkeypatch.setattr(treap, "OPEN_CELLS", 40)  # deepest first
    for rows in ([0], [5], [36], [1, 2, 3], list(range(0, 37, 3)), list(range(37))):
        w = rng.integers(1, 50, len(rows))
        sums = w @ grid[rows]
        want = sorted(((-s, i, d) for d, (s, i) in enumerate(zip(sums, ids)) if s), key=lambda x: x[:2])[:10]
        docs, scores = t.search(np.array(rows), w, ids, 10)
        assert list(zip(-scores, ids[docs], docs)) == want


def test_search_equals_scoring_all(spark, edges, monkeypatch):
    monkeypatch.setattr(treap, "SHARD_POSTINGS", 300)
    monkeypatch.setattr(treap, "BLOCK_TERMS", 60)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(200)] + ["Ünï", "ünï", "A1", "a1"]
    rows = [(k if k % 7 else None, " ".join(rng.choices(words, weights=[1 / (n + 1) for n in range(len(words))], k=rng.choice([0, 3, 30, 200])))) for k in range(150)]
    rows += [(500, rows[9][1]), (501, rows[9][1]), (501, rows[9][1]), (502, None), (503, " .,\n")]
    items = [(k, " ".join(rng.choices(words, k=12))) for k in range(30)] + [(None, "w1 w2"), (7, None), (8, "nosuchword"), (9, "w5"), (9, "w5"), (10, rows[9][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("score", "doc", "terms", "rank", "item", "shard")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumns({c: F.lit("x") for c in ("item", "terms", "doc_id", "w", "number", "block")})
    assert same(treap.op11(docs, asked).collect(), plain_search(rows, items))
    edge_rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    questions = [(1, "the same text, words"), (2, "IDIOT word3"), (3, "é 漢字 Σ")]
    assert same(treap.op11(edges, spark.createDataFrame(questions, "item_id long, text string")).collect(), plain_search(edge_rows, questions))


def test_tournament_tree_is_first_fit():
    rng = random.Random(1)
    for room in (10, 100, 1024):
        lengths = [rng.randint(1, room - 1) for _ in range(300)]
        left, want = [], []
        for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
            place = next((b for b, x in enumerate(left) if x >= lengths[k]), len(left))
            if place == len(left):
                left.append(room)
                want.append([])
            left[place] -= lengths[k]
            want[place].append(k)
        held = ffd.first_fit_decreasing(lengths, room)
        assert held == want
        parts = ffd.filled(held, lengths, room)
        assert sum(sum(n for *_, n in b) < room for b in parts) <= 1 and all(sum(n for *_, n in b) <= room for b in parts)
        covered = sorted((k, a, n) for b in parts for k, a, n in b)
        for k, length in enumerate(lengths):
            at = 0
            for _, a, n in (x for x in covered if x[0] == k):
                assert a == at
                at += n
            assert at == length


def check_packing(docs, placed, end_id, room=ffd.ROOM):
    encode = Tokenizer.from_file(BYTE)
    encode.no_truncation()
    encode.no_padding()
    want, have = collections.Counter(), collections.defaultdict(list)
    for r in docs.collect():
        ids = encode.encode(r["text"] or "", add_special_tokens=False).ids + [end_id]
        want[r["doc_id"], len(ids)] += len(ids)
        have[r["doc_id"], len(ids)].append(ids)
    got, bins = collections.Counter(), collections.defaultdict(list)
    for r in placed:
        got[r["doc_id"], r["doc_tokens"]] += r["length"]
        pieces = [zlib.crc32(array("I", ids[r["start"]:r["start"] + r["length"]]).tobytes()) for ids in have[r["doc_id"], r["doc_tokens"]]]
        assert r["ids_crc32"] in pieces
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= room
    return bins


def test_tournament_packing(spark, edges):
    assert check_packing(edges, ffd.op12(edges, BYTE).collect(), 0)
    # equal lengths over half a sequence: first fit alone would leave two fifths empty
    docs = spark.createDataFrame([(k % 50 or None, "word " * 599) for k in range(300)], "doc_id long, text string")
    bins = check_packing(docs, ffd.pack(ffd.cut(docs, BYTE, 0), group_pieces=100).collect(), 0)
    assert sum(sum(n for _, n in b) < ffd.ROOM for b in bins.values()) <= 6
    pieces = ffd.cut(docs.limit(40), BYTE, 0)
    whole = ffd.sequences(ffd.pack(pieces, with_ids=True)).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == pieces.agg(F.sum("length")).first()[0] and max(len(r["ids"]) for r in whole) == 4 * ffd.ROOM


def plain_merkle(rows):
    """op13 of (doc_id, source, lang, n_chars, text) rows, a list of trees in memory."""
    def h(parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def leaf(*values):
        return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(out[-1][k:k + 8]) for k in range(0, len(out[-1]), 8)])
        return out

    def climb(tree, at, now):
        proof = []
        for level in tree[:-1]:
            run, k = level[at // 8 * 8:][:8], at % 8
            proof += run[:k] + run[k + 1:]
            now, at = h(run[:k] + [now] + run[k + 1:]), at // 8
        return proof, now

    by_lang = collections.defaultdict(list)
    for d, source, lang, n, text in rows:
        changed = text is not None and d is not None and zlib.crc32(str(d).encode()) % 3 == 0
        by_lang[lang].append((d, leaf(d, source, lang, n, text), leaf(d, source, lang, n, text.translate(LOWER) if changed else text)))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(levels([r[1] for r in by_lang[lang]]))
    top, out = levels([t[-1][0] for t in trees]), []
    for number, lang in enumerate(order):
        for at, (d, own, now) in enumerate(by_lang[lang]):
            proof, now = climb(trees[number], at, now)
            more, now = climb(top, number, now)
            out.append((d, own, trees[number][-1][0], top[-1][0], h(proof + more), now, now == top[-1][0]))
    return out


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n, langs, upper", [(1, 1, 9), (8, 1, 9), (9, 1, 0), (65, 2, 0), (600, 3, 5), (600, 3, 10_000), (150, 70, 3), (150, 70, 30)])
def test_merkle_equals_a_plain_tree(spark, n, langs, upper, monkeypatch):
    monkeypatch.setattr(merkle, "TASK_ROWS", 50)
    rows = [(k if k % 11 else None, None if k % 5 == 0 else f"s{k}", None if k % langs == 0 else f"ä{k % langs}", k or None, None if k % 13 == 5 else f"Text Ü {k % 4}") for k in range(n)]
    rows += rows[:n // 3]  # repeated rows
    docs = spark.createDataFrame(rows, FIELDS).withColumns({c: F.lit("x") for c in ("digest", "tree", "pos", "n", "current", "run", "id", "level")})
    built = merkle.Manifest(docs, upper)
    want = plain_merkle(rows)
    got = [(r["doc_id"], bytes(r["digest"]).hex(), hashlib.sha256(bytes(r["siblings"]).hex().encode()).hexdigest(), bytes(r["folded"]).hex()) for r in built.proofs().collect()]
    assert built.root.hex() == want[0][3]
    assert sorted(got, key=key) == sorted(((r[0], r[1], r[4], r[5]) for r in want), key=key)
    if n == 600 and upper > 5:
        assert same(merkle.op13(docs).collect(), want)
        assert not all(r[-1] for r in want) and any(r[-1] for r in want)


def test_merkle_edges(spark, edges):
    docs = edges.withColumn("n_chars", F.length("text").cast("long"))
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert same(merkle.op13(docs).collect(), plain_merkle(rows))


def test_oracles_equal_plain_versions(spark):
    """The DuckDB texts say the same as the plain versions, NULLs and ties included."""
    rows = [(k if k % 9 else None, f"s{k % 3}", None if k % 4 == 0 else f"l{k % 4}", k, None if k % 8 == 3 else f"Some TEXT {k % 5} of words {k}") for k in range(100)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, source varchar, lang varchar, n_chars bigint, text varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?, ?)", rows)
    con.execute("create table benchmark as select * from (values (1, 'some words'), (2, 'text 7'), (3, null), (4, 'none')) t(item_id, text)")
    assert same(con.execute(oracles.merkle(3, 2)).fetchall(), plain_merkle(rows))
    items = [(1, "some words"), (2, "text 7"), (3, None), (4, "none")]
    assert same(con.execute(oracles.ranked_search()).fetchall(), plain_search([(r[0], r[4]) for r in rows], items))


def test_empty_tables_of_the_new_operators(spark, edges):
    none = edges.withColumn("n_chars", F.lit(1)).limit(0)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert treap.op11(none, items).collect() == [] and treap.op11(edges, items.limit(0)).collect() == []
    assert ffd.op12(none, BYTE).collect() == [] and merkle.op13(none).collect() == []


def test_bpe_of_every_character():
    """Ids of each code point, alone in words of its own and inside one, are the library's."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), bpe.codec(path)
    points = [chr(k) for k in range(0x110000) if not 0xD800 <= k < 0xE000 and (k < 0x30000 or k % 997 == 0)]
    for at in range(0, len(points), 256):
        text = " ".join(f"{c} a{c}B {c}{c}9{c}" for c in points[at : at + 256])
        want = library.encode(text, add_special_tokens=False).ids
        n, ids, decoded = own.round_trip(text)
        assert ids.decode() == " ".join(map(str, want)), [c for c in points[at : at + 256] if own.encode(f"a{c}B") != library.encode(f"a{c}B", add_special_tokens=False).ids]
        assert n == len(want) and decoded.decode() == library.decode(want, skip_special_tokens=False)


def test_shards_stay_equal_without_ids(spark):
    """A third of the ids NULL and a third the same: no shard gets them all."""
    rows = [((None, 7, k)[k % 3], f"text {k} " * (k % 5)) for k in range(3000)]
    got = sharding.op8(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    held = got.groupby("shard")["size"].sum()
    assert len(got) == 3000 and len(held) == 16 and held.max() - held.min() <= 60
    assert all(sorted(s) == list(range(len(s))) for _, s in got.groupby("shard")["slot"])
    assert sorted(zip(got["size"], got["text_crc32"])) == sorted((len(t) + 1, zlib.crc32(t.encode())) for _, t in rows)


def test_masking_takes_a_text_by_itself(spark):
    """NULL and repeated ids, and columns named as those used inside."""
    key = "ab12cd34ef56ab78cd90"
    rows = [(None, f"password = {key} here", "x"), (None, f"nothing of it: {key}0 stands", "x"), (None, None, "x"), (1, f"token: {key} and {key}", "x"), (1, "plain", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _secrets string").withColumns({c: F.lit("y") for c in ("secrets", "row", "id", "text_key", "a.b")})
    found = secret_scan.findings(docs, "_secrets").withColumn("is_secret", F.col("candidate") == key)
    got = secret_scan.masked(docs, found)
    assert got.columns == docs.columns
    assert sorted((r["text"] or "") for r in got.collect()) == sorted(["password = [SECRET] here", f"nothing of it: {key}0 stands", "", "token: [SECRET] and [SECRET]", "plain"])


def test_pipeline_judges_rows_without_ids(spark, edges):
    import corpus_pipeline as p
    rng = np.random.default_rng(4)
    prose = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 60)) for _ in range(6)]
    near = prose[0].rsplit(" ", 1)[0] + " changed"
    rows = [(None, prose[0]), (None, prose[0]), (None, near), (5, prose[1]), (5, prose[2]), (6, prose[2]), (7, prose[3]), (7, prose[3]), (None, "too short"), (8, "short too"), (None, None)]
    docs = spark.createDataFrame([(*r, "en", "a", "z") for r in rows], "doc_id long, text string, lang string, source string, class_id string")
    kept = [r["text"] for r in p.copies(spark, docs, "").collect()]
    assert sorted(t or "" for t in kept if t not in (prose[0], near)) == sorted([prose[1], prose[2], prose[3], "too short", "short too", ""])
    assert sum(t in (prose[0], near) for t in kept) == 1
    good = p.poor(spark, docs, "")
    assert good.columns == docs.columns and {r["text"] for r in good.collect()} == {*prose[:4], near} and good.count() == 8
