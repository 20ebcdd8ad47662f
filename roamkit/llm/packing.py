"""Best-fit packing planned on the histogram of lengths.

Only documents longer than a sequence are cut.  How many pieces have each length is all
the plan needs: going down the lengths, pieces fill the open sequences with the least
room that still takes them (best fit decreasing), many at a time.  A plan row says: of
length L, ranks ``first`` to ``last`` go to sequences from ``sequence`` on, ``each`` to a
sequence, starting at ``offset``.  Pieces then take planned places by joining their rank
within their length to the plan.  Ranks come from counts per (length, bucket), so a
length that holds most pieces is still ranked by many tasks.

Defined cases: NULL text counts as empty and gives the end id alone; rows without a doc_id
or that share one are packed like others; an empty table gives no rows; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roamkit.llm.shared import python_tasks, stage
from roamkit.llm.tokens import encoder

ROOM = 1024
#: Pieces a bucket holds on average when ranking, and so rows in a window of one task.
BUCKET_ROWS = 200_000


def plan(counts: dict[int, int], room: int = ROOM) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over counts: (length, first, last, sequence, each, offset) rows, last excluded.

    Open sequences are held as groups of equal room, so the plan grows with the number of
    lengths (at most ``room``), not with that of pieces.
    """
    open_: dict[int, list[tuple[int, int]]] = {}  # room left -> groups (first sequence, sequences)
    rows, made = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            fits = min((r for r in open_ if r >= length), default=None)
            if fits is None:
                each = room // length
                first, n, fits = made, -(-left // each), room
                made += n
            else:
                first, n = open_[fits].pop()
                if not open_[fits]:
                    del open_[fits]
                each = fits // length
            full = min(n, left // each)  # sequences that take ``each`` pieces
            if full:
                rows.append((length, rank, rank + full * each, first, each, room - fits))
                if fits - each * length:
                    open_.setdefault(fits - each * length, []).append((first, full))
                rank, left = rank + full * each, left - full * each
            if full < n and left:  # one more takes what is left, fewer than ``each``
                rows.append((length, rank, rank + left, first + full, each, room - fits))
                open_.setdefault(fits - left * length, []).append((first + full, 1))
                full, left = full + 1, 0
            if full < n:
                open_.setdefault(fits, []).append((first + full, n - full))
    return rows


PIECES = "doc_id long, piece int, start long, length long, ids binary, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, room: int = ROOM) -> DataFrame:
    """Ids of each document with the end id, cut into pieces of ``room``; the first may be shorter."""
    python_tasks(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            rows = []
            for doc_id, ids in zip(pdf["doc_id"], encode(pdf["text"].tolist()), strict=True):
                ids += end
                n = len(ids) // 4
                at = [0, *range(n % room or room, n, room), n]
                for k, (a, b) in enumerate(zip(at, at[1:])):
                    rows.append((doc_id, k, a, b - a, ids[4 * a : 4 * b], zlib.crc32(ids[4 * a : 4 * b])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(cut, PIECES)


def pack(cut: DataFrame, room: int = ROOM) -> DataFrame:
    """Adds sequence_id and offset to pieces (a written table with doc_id, piece and length).

    The driver holds one count per length; the plan is broadcast and has a few rows a length.
    """
    spark, n = cut.sparkSession, cut.count()
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(1, n // BUCKET_ROWS))).alias("bucket")
    keyed = cut.drop("ids").withColumn("bucket", bucket)
    counts = stage(keyed.groupBy("length", "bucket").agg(F.count("*").alias("n")), "length-counts")
    planned = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, room)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = keyed.withColumn("rank", rank).join(starts, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    schema = "length long, first long, last long, sequence long, each long, at long"
    places = F.broadcast(spark.createDataFrame(planned, schema))
    within = (ranked["length"] == places["length"]) & (ranked["rank"] >= places["first"]) & (ranked["rank"] < places["last"])
    turn = F.col("rank") - F.col("first")
    return ranked.join(places, within).select(
        "doc_id", "piece", "start", ranked["length"], "ids_crc32", (F.col("sequence") + F.floor(turn / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + turn % F.col("each") * ranked["length"]).cast("long").alias("offset"))


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """The operator's own output: the ids of each packed sequence, in place order."""
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    given = cut.select(*keys, "ids").dropDuplicates(keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "ids")
    same = [packed[k].eqNullSafe(given[f"_{k}"]) for k in keys]  # a piece may have no doc_id
    rows = packed.join(given, same)
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(ordered.alias("parts")).select("sequence_id", F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))


def op5(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The registered query."""
    return pack(stage(pieces(docs, vocabulary, end_id=2), "pieces"))
