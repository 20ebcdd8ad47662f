"""First-fit decreasing with a tournament tree, run alone in randomised groups of documents.

A document's ids are cut into blocks of a whole sequence and a rest.  A block is a sequence
by itself and goes nowhere.  The rests are dealt at random into groups of about
``GROUP_PIECES``; a group is packed in one task, by first-fit decreasing: a tournament tree
over the bins holds in each inner node the largest room below it, so that the first bin
with enough room is found, and its room updated, on one path of the tree.  As the groups
are random, each has the mix of lengths of the whole table, and bins left open are few.

Where lengths don't go together (many equal ones over half a sequence, say), first fit
leaves room in many bins.  So the emptiest bins are then opened again, and their pieces,
cut where need be, fill the room of the others, until at most one bin of the group has
room.  Other pieces stay whole.

A group is bounded: ``GROUP_PIECES`` rests of less than a sequence, about 16 MB of ids, and
whatever one key or text is common, since groups are dealt by the row's number.

Defined cases: NULL text counts as empty and gives the end id alone; rows without a doc_id,
or that share one, are documents of their own; a very long text is blocks and one rest;
a text whose ids fill its sequences has no rest; an empty table gives no rows; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roamkit.llm.shared import python_tasks, stage
from roamkit.llm.tokens import encoder

ROOM = 1024
#: Rests of a group on average: first fit leaves little room in a group of a thousand, and a task sorts it in a moment.
GROUP_PIECES = 4096
#: Seed of the deal into groups.
SEED = 12


class Bins:
    """A tournament tree over ``n`` empty bins: ``tree[1]`` is the largest room, the leaves start at ``half``."""

    def __init__(self, n: int, room: int):
        self.half = 1 << max(0, n - 1).bit_length()
        self.tree = [room] * (2 * self.half)

    def first(self, size: int) -> int:
        """Put ``size`` into the first bin that takes it; the bin's number."""
        tree, at = self.tree, 1
        while at < self.half:
            at *= 2
            if tree[at] < size:
                at += 1
        place = at - self.half
        tree[at] -= size
        while at > 1:
            at //= 2
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
        return place

    def room(self, place: int) -> int:
        return self.tree[self.half + place]


def first_fit_decreasing(lengths: list[int], room: int = ROOM) -> list[list[int]]:
    """The bins, each a list of places in ``lengths``.  Equal lengths keep their order."""
    bins, held = Bins(len(lengths), room), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        place = bins.first(lengths[k])
        if place == len(held):
            held.append([])
        held[place].append(k)
    return held


def filled(held: list[list[int]], lengths: list[int], room: int = ROOM) -> list[list[tuple[int, int, int]]]:
    """Bins of (piece, start in it, length) after the emptiest bins' pieces have filled the others."""
    full = [sum(lengths[k] for k in b) for b in held]
    order = sorted(range(len(held)), key=lambda b: (-full[b], b))
    out = [[(k, 0, lengths[k]) for k in held[b]] for b in order]
    left = [room - full[b] for b in order]
    to, last = 0, len(out) - 1
    while to < last:
        if not left[to]:
            to += 1
            continue
        piece, start, length = out[last].pop()
        part = min(length, left[to])
        out[to].append((piece, start, part))
        left[to] -= part
        left[last] += part
        if part < length:
            out[last].append((piece, start + part, length - part))
        elif not out[last]:
            out.pop()
            last -= 1
    return out


PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def cut(docs: DataFrame, vocabulary: str, end_id: int, room: int = ROOM) -> DataFrame:
    """Blocks of ``room`` ids of each document with the end id, and its rest; staged, with a number a row."""
    python_tasks(docs.sparkSession)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            rows = []
            for doc_id, ids in zip(pdf["doc_id"], encode(pdf["text"].tolist()), strict=True):
                ids += end
                n = len(ids) // 4
                rows += [(doc_id, a, min(room, n - a), n, ids[4 * a : 4 * (a + room)]) for a in range(0, n, room)]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens", "ids"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stage(rows.mapInPandas(blocks, PIECES).withColumn("row", F.monotonically_increasing_id()), "blocks")


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(pieces: DataFrame, room: int = ROOM, group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Places of all ``pieces`` (of ``cut``).  A block's sequence is -1 - row, the others group * 2 ** 32 + bin.

    ``with_ids`` adds the ids of each piece.
    """
    schema = PLACED + (", ids binary" if with_ids else "")
    rests = pieces.where(F.col("length") < room)
    groups = max(1, -(-rests.count() // group_pieces))

    def rows_of(pdf: pd.DataFrame, places: list[tuple[int, int, int, int, int]]) -> pd.DataFrame:
        """``places``: (row of pdf, start in it, length, sequence, offset)."""
        at, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*places, strict=True))
        given = pdf["ids"].to_numpy()
        ids = [given[k][4 * a : 4 * (a + n)] for k, a, n in zip(at, start, length, strict=True)]
        out = pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").to_numpy()[at], "start": pdf["start"].to_numpy()[at] + start, "length": length,
                            "ids_crc32": [zlib.crc32(x) for x in ids], "doc_tokens": pdf["doc_tokens"].to_numpy()[at], "sequence_id": sequence, "offset": offset})
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out.assign(ids=ids) if with_ids else out

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield rows_of(pdf, [(k, 0, room, -1 - row, 0) for k, row in enumerate(pdf["row"].tolist())])

    def together(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row", ignore_index=True)
        lengths, places = pdf["length"].tolist(), []
        for number, parts in enumerate(filled(first_fit_decreasing(lengths, room), lengths, room)):
            offset = 0
            for k, start, length in parts:
                places.append((k, start, length, (int(pdf["group"][0]) << 32) + number, offset))
                offset += length
        return rows_of(pdf, places)

    group = F.pmod(F.xxhash64("row", F.lit(SEED)), F.lit(groups)).alias("group")
    in_groups = rests.select("*", group).groupBy("group").applyInPandas(together, schema)
    return in_groups.unionByName(pieces.where(F.col("length") == room).mapInPandas(alone, schema))


def sequences(placed: DataFrame) -> DataFrame:
    """The operator's own output, from places with ids: the ids of each sequence in order, at most ``ROOM``."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    rows = placed.groupBy("sequence_id").agg(ordered.alias("parts"))
    return rows.select("sequence_id", F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))


def op12(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The registered query."""
    return pack(cut(docs, vocabulary, end_id=0))
