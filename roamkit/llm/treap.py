"""Ranked lexical search in a K2-treap over the grid of terms and documents.

Index: a pass counts each document's terms, since an occurrence's impact needs the number
of documents and of terms.  Then each scan task writes its documents as shards of at most
``SHARD_POSTINGS`` postings.  A shard is a square grid, a row a term (by falling document
frequency), a column a document.  A cell is split into four down to single points; empty
cells are not stored, and a cell with one point is that point, without the cells below it.
Stored, level by level, are each cell's four-bit mask (its children follow by counting
bits) and the largest impact in it.

Search: a range of documents, at the start all of a shard, has for each term of the item
the cell at the crossing of the term's row and the range.  The sum of weight times largest
impact over these cells bounds every score in the range; at a single document it is the
score.  Ranges are halved best first, all rows' paths descending together, a batch of
ranges at a time; one whose bound is below the k-th best score so far is given up.  Until k
documents are found, and where the open ranges would take too much memory, the deepest
ranges go first.  The shards' best k merge exactly, as weights and impacts are global.

Terms are compared as bytes (the hash that finds them is only a first look).  All of a
score but the weights' logarithm is integer arithmetic.

Defined cases: NULL text counts as empty; a document without terms counts nowhere and is
never found; an item without terms, or whose terms no document has, finds nothing; rows
without a doc_id are found and rank last among equal scores; rows that share a doc_id (or
items an item_id) are documents (items) of their own; a very long text is one column of the
grid, in a shard that may exceed the bound by it; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
import string
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamkit.llm.search import _load, _save
from roamkit.llm.shared import open_store, python_tasks, run_dir, stage

#: A term is a run of other characters than these ASCII ones.
ASCII_OTHERS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
TERM, SEPARATOR = f"[^{ASCII_OTHERS}]+", f"[{ASCII_OTHERS}]+"
#: Bytes of a text as split() wants them: A-Z lower-cased, separators blank, the rest as it is.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: Bound on a shard: about 20 bytes a posting on disk and 60 while it is built.
SHARD_POSTINGS = 2_000_000
#: Terms of the items that a search task holds at once.
BLOCK_TERMS = 100_000
#: Ranges halved at once, and cells of open ranges before the deepest go first.
BATCH, OPEN_CELLS = 256, 8_000_000
NO_DOC = -(2**63)
BITS = np.array([bin(k).count("1") for k in range(16)], np.int32)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TABLE).split()


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """Of ``tf`` occurrences in a document of ``n`` terms, of ``docs`` documents with ``terms`` terms in all."""
    tf, m = tf.astype(np.int64), 10 + 90 * n.astype(np.int64) * docs // max(1, terms)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers, a zero before each."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(keep)
    return x


def hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


class Treap:
    """The cells of a shard, and the descent through them."""

    @staticmethod
    def build(row: np.ndarray, doc: np.ndarray, impact: np.ndarray) -> dict[str, np.ndarray]:
        """Arrays of the cells, from distinct points."""
        height = int(max(row.max(), doc.max())).bit_length()
        code = (spread(row) << np.uint64(1)) | spread(doc)
        order = np.argsort(code)
        code, impact = code[order], impact[order]
        masks, largest, points, live = [], [], [], np.arange(len(code))
        for level in range(height + 1):
            key = code[live] >> np.uint64(2 * (height - level))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            largest.append(np.maximum.reduceat(impact[live], first))
            single = size == 1
            points.append(order[live[first[single]]])
            mask = np.zeros(len(first), np.uint8)
            if level < height:
                quarter = (code[live] >> np.uint64(2 * (height - level - 1))).astype(np.uint8) & 3
                mask = np.where(single, 0, np.bitwise_or.reduceat(np.left_shift(1, quarter).astype(np.uint8), first)).astype(np.uint8)
            masks.append(mask)
            live = live[~np.repeat(single, size)]
            if not len(live):
                break
        at = np.concatenate(points)
        return {"height": np.array(height), "mask": np.concatenate(masks), "largest": np.concatenate(largest).astype(np.int32), "row": row[at].astype(np.int32), "doc": doc[at].astype(np.int32)}

    def __init__(self, z: dict[str, np.ndarray]):
        self.height, self.mask, self.largest = int(z["height"]), z["mask"], z["largest"]
        self.first = 1 + np.r_[0, np.cumsum(BITS[self.mask])[:-1]].astype(np.int32)  # children come in the order of their parents
        self.point = (np.cumsum(self.mask == 0) - 1).astype(np.int32)
        self.row, self.doc = z["row"], z["doc"]

    def halved(self, level: np.ndarray, place: np.ndarray, cells: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
        """Level, place (the range's number at its level), cells (-1: empty) and bound of both halves of ranges."""
        n, (at, term) = len(level), np.nonzero(cells >= 0)
        cell, shift = cells[at, term], (self.height - 1 - level)[at]
        mask, quarter = self.mask[cell], (2 * ((rows[term] >> shift) & 1)).astype(np.uint8)
        left, right = (mask >> quarter) & 1 > 0, (mask >> quarter) & 2 > 0
        child = self.first[cell] + BITS[mask & (np.left_shift(1, quarter) - 1).astype(np.uint8)]
        alone = mask == 0
        side = (self.doc[self.point[cell[alone]]] >> shift[alone]) & 1
        to = np.concatenate([at[left], at[right] + n, at[alone] + n * side])
        term = np.concatenate([term[left], term[right], term[alone]])
        new = np.concatenate([child[left], child[right] + left[right], cell[alone]])
        mine = self._own_row(new, rows[term])
        to, term, new = to[mine], term[mine], new[mine]
        out = np.full((2 * n, cells.shape[1]), -1, np.int32)
        out[to, term] = new
        return np.r_[level, level] + 1, np.r_[2 * place, 2 * place + 1], out, self.bounds(to, new, weights[term], 2 * n)

    def _own_row(self, cells: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """False for cells that are one point of another row than the path's."""
        own = np.ones(len(cells), bool)
        alone = np.flatnonzero(self.mask[cells] == 0)
        own[alone] = self.row[self.point[cells[alone]]] == rows[alone]
        return own

    def bounds(self, ranges: np.ndarray, cells: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
        """Sums a range of weight times largest impact; they are whole numbers below 2 ** 53, so doubles hold them."""
        return np.bincount(ranges, weights * self.largest[cells].astype(np.float64), n).astype(np.int64)

    def search(self, rows: np.ndarray, weights: np.ndarray, doc_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of the k best documents, best first, for the terms' rows and weights."""
        docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
        cells = np.where(self._own_row(np.zeros(len(rows), np.int32), rows), 0, -1).astype(np.int32)[None, :]
        live = np.flatnonzero(cells[0] == 0)
        level, place, bound = np.zeros(1, np.int64), np.zeros(1, np.int64), self.bounds(0 * live, 0 * live, weights[live], 1)
        batch = max(1, min(BATCH, OPEN_CELLS // max(1, 8 * len(rows))))
        while len(level):
            deep = len(docs) < k or cells.size > OPEN_CELLS
            order = np.lexsort((-bound, -level)) if deep else np.argsort(-bound, kind="stable")
            now, later = order[: min(batch, 32) if deep else batch], order[min(batch, 32) if deep else batch :]
            ended = level[now] == self.height
            if ended.any():
                docs, scores = np.r_[docs, place[now][ended]], np.r_[scores, bound[now][ended]]
                key = doc_id[docs]
                best = np.lexsort((key, key == NO_DOC, -scores))[:k]
                docs, scores = docs[best], scores[best]
                least = max(1, scores[-1]) if len(docs) == k else 1
            go = now[~ended]
            new_level, new_place, new_cells, new_bound = self.halved(level[go], place[go], cells[go], rows, weights)
            good, rest = new_bound >= least, later[bound[later] >= least]
            level, place = np.r_[level[rest], new_level[good]], np.r_[place[rest], new_place[good]]
            cells, bound = np.r_[cells[rest], new_cells[good]], np.r_[bound[rest], new_bound[good]]
        return docs, scores


class Terms:
    """A shard's dictionary: the row and document frequency of a term."""

    @staticmethod
    def build(terms: list[bytes], df: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Arrays, and the row of each given term: rows go by falling frequency."""
        row = np.empty(len(terms), np.int64)
        row[np.argsort(-df, kind="stable")] = np.arange(len(terms))
        key = hashes(terms)
        order = np.argsort(key, kind="stable")
        text = b"".join(map(terms.__getitem__, order.tolist()))
        start = np.cumsum(np.r_[0, np.fromiter(map(len, terms), np.int64, len(terms))[order]])
        return {"hash": key[order], "start": start.astype(np.int64), "text": np.frombuffer(text, np.uint8), "row": row[order].astype(np.int32), "df": df[order].astype(np.int64)}, row

    def __init__(self, z: dict[str, np.ndarray]):
        self.hash, self.start, self.text, self.row, self.df = z["hash"], z["start"], z["text"], z["row"], z["df"]

    def find(self, terms: list[bytes]) -> np.ndarray:
        """The place of each term here, or -1."""
        at = np.searchsorted(self.hash, key := hashes(terms))
        out = np.full(len(terms), -1)
        for i, (term, k, h) in enumerate(zip(terms, at.tolist(), key, strict=True)):
            while k < len(self.hash) and self.hash[k] == h:
                if self.text[self.start[k] : self.start[k + 1]].tobytes() == term:
                    out[i] = k
                    break
                k += 1
        return out


def numbering() -> defaultdict[bytes, int]:
    """Gives each new key the next number."""
    out: defaultdict[bytes, int] = defaultdict()
    out.default_factory = out.__len__
    return out


def totals(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms of all documents."""
    n = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(TERM))
    row = docs.select(n.cast("long").alias("n")).where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    return row["docs"], row["terms"] or 0


def write_index(docs: DataFrame, folder: str, n_docs: int, n_terms: int) -> DataFrame:
    """Write the shards into ``folder``: one row each, with its name and its number of documents, terms and postings."""
    python_tasks(docs.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        numbers = numbering()
        doc_ids, lengths, term, tf, distinct = [], [], [], [], []

        def flush() -> pd.DataFrame:
            name = uuid.uuid4().hex
            row, doc = np.concatenate(term), np.repeat(np.arange(len(distinct)), distinct)
            arrays, by_row = Terms.build(list(numbers), np.bincount(row, minlength=len(numbers)))
            _save(store, f"{root}/{name}.terms", **arrays)
            impact = impacts(np.concatenate(tf), np.array(lengths)[doc], n_docs, n_terms)
            _save(store, f"{root}/{name}.cells", doc_id=np.array(doc_ids, np.int64), **Treap.build(by_row[row], doc, impact))
            return pd.DataFrame({"shard": [name], "docs": [len(distinct)], "terms": [len(numbers)], "postings": [len(row)]})

        held = 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc"], pdf["text"], strict=True):
                count = Counter(terms_of(text))
                if not count:
                    continue
                term.append(np.fromiter(map(numbers.__getitem__, count), np.int32, len(count)))
                tf.append(np.fromiter(count.values(), np.int64, len(count)))
                doc_ids.append(doc_id)
                lengths.append(count.total())
                distinct.append(len(count))
                held += len(count)
                if held >= SHARD_POSTINGS:
                    yield flush()
                    numbers, doc_ids, lengths, term, tf, distinct, held = numbering(), [], [], [], [], [], 0
        if held:
            yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_DOC)).alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    return stage(rows.mapInPandas(write, "shard string, docs long, terms long, postings long"), "treap-shards")


def asked_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms): the distinct terms of each item's text, as an array; ``item`` numbers the rows."""
    words = F.split(F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase), SEPARATOR)
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))).alias("terms"))
    return stage(rows.where(F.size("terms") > 0), "asked")


class Index:
    """The shards of a table, in a folder that all executors reach."""

    def __init__(self, docs: DataFrame):
        self.spark, self.folder = docs.sparkSession, run_dir(docs.sparkSession, "treap")
        self.docs, self.terms = totals(docs)
        self.shards = write_index(docs, self.folder, self.docs, self.terms)
        self.n = self.shards.count()

    def _tasks(self, blocks: DataFrame, made: int) -> DataFrame:
        """(shard, block): every shard takes every block of items; names of files only."""
        numbers = self.shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(made - 1))).alias("number"))
        return numbers.join(blocks, "number").select("shard", "block").repartition(max(1, self.n * made), "shard", "block")

    def _blocks(self, rows: DataFrame, made: int, columns: list[str]) -> DataFrame:
        """Rows of items as files: (number, block), a block for each ``number``."""
        folder = self.folder

        def write(pdf: pd.DataFrame) -> pd.DataFrame:
            store, root = open_store(folder)
            store.create_dir(root, recursive=True)
            name = f"{uuid.uuid4().hex}.items"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(pdf[columns].to_json(orient="records").encode())
            return pd.DataFrame({"number": [int(pdf["number"].iloc[0])], "block": [name]})

        numbered = rows.withColumn("number", F.pmod(F.xxhash64("item"), F.lit(made)).cast("int"))
        return stage(numbered.groupBy("number").applyInPandas(write, "number int, block string"), "treap-blocks")

    def frequencies(self, blocks: DataFrame, made: int) -> DataFrame:
        """(term, df) of the items' terms over all shards."""
        folder = self.folder

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, root = open_store(folder)
            for pdf in batches:
                for shard, block in zip(pdf["shard"], pdf["block"], strict=True):
                    own, asked = Terms(_load(store, f"{root}/{shard}.terms")), read_block(store, f"{root}/{block}")
                    terms = sorted({t for words in asked["terms"] for t in words})
                    at = own.find([t.encode() for t in terms])
                    yield pd.DataFrame({"term": [t for t, k in zip(terms, at, strict=True) if k >= 0], "df": own.df[at[at >= 0]], "block": block}).astype({"term": "object", "df": "int64"})

        found = self._tasks(blocks, made).mapInPandas(look, "term string, df long, block string")
        return found.groupBy("block", "term").agg(F.sum("df").alias("df")).groupBy("term").agg(F.max("df").alias("df"))

    def search(self, items: DataFrame, k: int = 10) -> DataFrame:
        """(item_id, rank, doc_id, score): the k best documents of each item (item_id, text)."""
        asked = asked_terms(items)
        total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
        made = max(1, -(-total // BLOCK_TERMS))
        df = self.frequencies(self._blocks(asked, made, ["terms"]), made)
        n = F.lit(self.docs)
        w = F.floor(1000 * F.log((2 * n + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
        known = df.select("term", w.alias("w")).where("w > 0")
        weighed = asked.select("item", "item_id", F.explode("terms").alias("term")).join(known, "term")
        weighed = stage(weighed.groupBy("item", "item_id").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("t")).select("item", "item_id", F.col("t.term").alias("terms"), F.col("t.w").alias("w")), "weighed")
        blocks, folder = self._blocks(weighed, made, ["item", "terms", "w"]), self.folder

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            store, root = open_store(folder)
            for pdf in batches:
                for shard, own in pdf.groupby("shard")["block"]:
                    terms, z = Terms(_load(store, f"{root}/{shard}.terms")), _load(store, f"{root}/{shard}.cells")
                    treap, doc_id = Treap(z), z["doc_id"]
                    for block in own:
                        rows = []
                        for item, words, w in read_block(store, f"{root}/{block}").itertuples(index=False):
                            at = terms.find([t.encode() for t in words])
                            if (at >= 0).any():
                                found, scores = treap.search(terms.row[at[at >= 0]].astype(np.int64), np.array(w, np.int64)[at >= 0], doc_id, k)
                                rows += [(item, doc_id[d], s) for d, s in zip(found, scores, strict=True)]
                        yield pd.DataFrame(rows, columns=["item", "doc", "score"]).astype("int64")

        found = self._tasks(blocks, made).mapInPandas(run, "item long, doc long, score long")
        rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc") == NO_DOC, "doc"))
        best = found.withColumn("rank", rank).where(F.col("rank") <= k)
        return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", F.when(F.col("doc") != NO_DOC, F.col("doc")).alias("doc_id"), "score")


def read_block(store, path: str) -> pd.DataFrame:
    with store.open_input_stream(path) as f:
        return pd.DataFrame(json.loads(f.read()))


def op11(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The registered query."""
    return Index(docs).search(items)
