"""Token files as wavelet matrices: one compressed file a shard, with rank and select.

A shard holds the ids of a run of documents in ascending doc_id order.  The id sequence
is stored as one bit-plane per bit, most significant first; each plane lists that bit of
all ids after a stable partition by the planes above it.  With counts of ones per block
a plane answers rank, and so the file answers: which id stands at a place (``access``),
how often an id occurs before a place (``rank``), and where its k-th occurrence is
(``select``).  ``tokens`` restores the whole sequence plane by plane.

File: magic, then little-endian 64-bit numbers (ids, documents, planes, length of each
part), then zlib parts: doc_ids, null flags, ids per document, and per plane its packed
bits followed by the ones before every block.

Defined cases: NULL text counts as empty and gives the end id alone; documents without a
doc_id come first; rows that share a doc_id stand next to each other, by text hash; an
empty table gives no file and no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamkit.llm.shared import open_store, python_tasks, run_dir, stage
from roamkit.llm.tokens import encoder

MAGIC, BLOCK = b"WAVELET1", 512
#: Ids a file holds before the task starts the next one: bounds the memory of a task.
FILE_IDS = 16_000_000
#: Texts encoded at a time, so that their words stay in the processor's cache.
TEXTS = 500


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray], ones: list[np.ndarray]):
        """``planes``: packed bits of each plane; ``ones``: ones before each block of ``BLOCK`` bits, and in all."""
        self.n, self.planes, self.ones = n, planes, ones

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits = max(1, int(ids.max(initial=0)).bit_length())
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, ones = [], []
        for k in reversed(range(bits)):
            b = (ids & ids.dtype.type(1 << k)).astype(bool)
            p = np.packbits(b)
            planes.append(p)
            ones.append(cls.counts(p))
            parted, zeros = np.empty_like(ids), len(ids) - int(ones[-1][-1])
            np.compress(~b, ids, out=parted[:zeros])
            np.compress(b, ids, out=parted[zeros:])
            ids = parted
        return cls(len(ids), planes, ones)

    @staticmethod
    def counts(packed: np.ndarray) -> np.ndarray:
        each = np.bitwise_count(packed).astype(np.int64)
        return np.r_[0, np.add.reduceat(each, np.arange(0, len(each), BLOCK // 8)).cumsum()] if len(each) else np.zeros(1, np.int64)

    def _ones_before(self, plane: int, at: int) -> int:
        block = at // BLOCK
        part = self.planes[plane][block * BLOCK // 8 : -(-at // 8)]
        return int(self.ones[plane][block]) + int(np.unpackbits(part)[: at - block * BLOCK].sum())

    def _zeros(self, plane: int) -> int:
        return self.n - int(self.ones[plane][-1])

    def access(self, at: int) -> int:
        value = 0
        for k in range(len(self.planes)):
            one, before = self.planes[k][at // 8] >> (7 - at % 8) & 1, self._ones_before(k, at)
            at = self._zeros(k) + before if one else at - before
            value = value << 1 | int(one)
        return value

    def _range(self, value: int, at: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``at`` stand in the last order."""
        first, last = 0, at
        for k in range(len(self.planes)):
            a, b = self._ones_before(k, first), self._ones_before(k, last)
            if value >> (len(self.planes) - 1 - k) & 1:
                first, last = self._zeros(k) + a, self._zeros(k) + b
            else:
                first, last = first - a, last - b
        return first, last

    def rank(self, value: int, at: int) -> int:
        """Occurrences of ``value`` among the first ``at`` ids."""
        if value >> len(self.planes):
            return 0
        first, last = self._range(value, at)
        return last - first

    def select(self, value: int, k: int) -> int:
        """The place of occurrence ``k`` (from 0) of ``value``; IndexError if there are fewer."""
        if not 0 <= k < self.rank(value, self.n):
            raise IndexError(f"id {value} has no occurrence {k}")
        at = self._range(value, 0)[0] + k
        for plane in reversed(range(len(self.planes))):
            one = at >= self._zeros(plane)
            at = self._select_bit(plane, one, at - self._zeros(plane) if one else at)
        return at

    def _select_bit(self, plane: int, one: bool, k: int) -> int:
        starts = self.ones[plane] if one else np.minimum(np.arange(len(self.ones[plane])) * BLOCK, self.n) - self.ones[plane]
        block = int(np.searchsorted(starts, k, side="right")) - 1
        bits = np.unpackbits(self.planes[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(bits == one)[k - int(starts[block])])

    def tokens(self) -> np.ndarray:
        """All ids in order: from the last plane up, undo each partition."""
        values = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for k in reversed(range(len(self.planes))):
            b, zeros = np.unpackbits(self.planes[k], count=self.n).view(bool), self._zeros(k)
            up = np.empty_like(values)
            up[~b] = values[:zeros]
            up[b] = values[zeros:] | values.dtype.type(1 << (len(self.planes) - 1 - k))
            values = up
        return values


def compressed(part: bytes) -> bytes:
    """A zlib stream of runs and Huffman codes: planes have few longer matches, and the search for them costs the most."""
    z = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return z.compress(part) + z.flush()


def to_bytes(doc_ids: list, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    w = WaveletMatrix.build(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(), known.tobytes(), lengths.astype("<u4").tobytes()]
    parts += [p.tobytes() + o.astype("<u4").tobytes() for p, o in zip(w.planes, w.ones, strict=True)]
    packed = [compressed(p) for p in parts]
    head = struct.pack(f"<{3 + len(packed)}Q", w.n, len(doc_ids), len(w.planes), *map(len, packed))
    return MAGIC + head + b"".join(packed)


def from_bytes(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """doc_ids (None: no doc_id), ids per document, and the matrix."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n, docs, planes = struct.unpack_from("<3Q", data, 8)
    sizes = struct.unpack_from(f"<{3 + planes}Q", data, 32)
    at, parts = 32 + 8 * (3 + planes), []
    for size in sizes:
        parts.append(zlib.decompress(data[at : at + size]))
        at += size
    doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8), strict=True)]
    cut = -(-n // 8)
    bits = [np.frombuffer(p[:cut], np.uint8) for p in parts[3:]]
    ones = [np.frombuffer(p[cut:], "<u4").astype(np.int64) for p in parts[3:]]
    return doc_ids, np.frombuffer(parts[2], "<u4").astype(np.int64), WaveletMatrix(n, bits, ones)


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Write the token files and return their manifest: part, seq, path, docs, ids (a row a file).

    The text is shuffled once, by ranges of doc_id; ids never leave the task that makes
    them but for the file.  A repeated task writes files of new names; the manifest names
    those of the attempt that Spark kept.
    """
    python_tasks(docs.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, (store, root) = encoder(vocabulary).encode, open_store(folder)
        end, attempt, seq = np.array([end_id], "<u4").tobytes(), uuid.uuid4().hex, 0
        store.create_dir(root, recursive=True)
        doc_ids, data, held, part = [], [], 0, 0

        def flush() -> pd.DataFrame:
            path = f"{root}/{attempt}-{seq:05d}.wavelet"
            ids = np.frombuffer(b"".join(data), "<u4")
            with store.open_output_stream(path) as f:
                f.write(to_bytes(doc_ids, np.array([len(x) // 4 for x in data]), ids))
            return pd.DataFrame({"part": [part], "seq": [seq], "path": [path], "docs": [len(doc_ids)], "ids": [len(ids)]})

        for pdf in batches:
            part = int(pdf["part"].iloc[0]) if len(pdf) else part
            texts = pdf["text"].tolist()
            ids = [x + end for a in range(0, len(texts), TEXTS) for x in encode(texts[a : a + TEXTS])]
            for doc_id, x in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), ids, strict=True):
                doc_ids.append(None if doc_id is None else int(doc_id))
                data.append(x)
                held += len(x) // 4
                if held >= FILE_IDS:
                    yield flush()
                    doc_ids, data, held, seq = [], [], 0, seq + 1
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    return rows.mapInPandas(write, "part int, seq int, path string, docs long, ids long")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids (packed) of every document of the files."""
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("start"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = open_store(folder)
        for pdf in batches:
            for path, start in zip(pdf["path"], pdf["start"], strict=True):
                with store.open_input_stream(path) as f:
                    doc_ids, lengths, matrix = from_bytes(f.read())
                data = matrix.tokens().astype("<u4").tobytes()
                ends = lengths.cumsum()
                for a in range(0, len(doc_ids), 1000):
                    some = slice(a, a + 1000)
                    yield pd.DataFrame({"doc_id": pd.array(doc_ids[some], dtype="Int64"), "start": start + (ends - lengths)[some],
                                        "ids": [data[4 * (e - k) : 4 * e] for e, k in zip(ends[some].tolist(), lengths[some].tolist(), strict=True)]})

    return files.repartition(n).mapInPandas(read, "doc_id long, start long, ids binary")


def op3(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The registered query."""
    folder = run_dir(docs.sparkSession, "wavelet")
    manifest = stage(write_tokens(docs, folder, vocabulary, end_id=1), "wavelet-manifest")
    ids = F.col("ids")
    return read_tokens(manifest, folder).select("doc_id", "start", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), F.crc32(ids).alias("ids_crc32"))
