"""Merkle manifest of a dataset, and a recursive query that climbs from each leaf to the root.

Build: a leaf is the hash of a row's fields.  Leaves are sorted by (lang, doc_id) with a
range exchange that carries hashes, not texts; a leaf's place in its tree is its place in
its partition plus the counts of the partitions before, so no task ever sees a whole tree.
Every ``ARITY`` neighbours become their parent, level by level; each level is written.  A
tree of a language ends in its subroot, and the subroots are the leaves of the top tree.
Every node below the root is one row: its number, its parent's, and its siblings' digests
left and right of it.

Climb: a row of the recursive query stands for a run of at most ``ARITY`` neighbouring
leaves, which have their path in common.  A step joins the node that the row has reached,
appends the node's siblings to the proof and folds the hash of each leaf of the run with
them; a leaf that was tampered with is folded from its tampered hash.  Nodes of the upper
levels, at most ``UPPER_NODES``, are broadcast, since all rows meet in them; lower nodes
have few rows each and are joined by a shuffle.  A row holds (2 * ARITY + levels * (ARITY - 1))
digests at most.

Defined cases: a NULL field hashes as ``-``, so NULL and empty differ; rows without a
doc_id come first in their tree and are never tampered with; rows that share a doc_id are
leaves of their own, in order of their hashes (equal rows are equal leaves, so their order
does not matter); a single leaf is its tree's subroot, a single subroot is the root, and
the proof of the only leaf of all is the hash of nothing; very long texts are hashed in the
scan and go no further; an empty table gives no rows; columns other than the five fields are
ignored, and none of the names used inside can clash with them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roamkit.llm.shared import let, stage

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree whose leaves are the subroots.  Trees of languages are numbered from 0.
TOP = -1
#: Nodes that a climb may broadcast: about 2.5 MB at ``ARITY`` siblings of 32 bytes.
UPPER_NODES = 10_000
#: Rows of a task when leaves are sorted.
TASK_ROWS = 1_000_000
#: Settings of Spark's recursive queries.  Both are guards against loops; a climb ends at the root.
LIMITS = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "100"}


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(fields[name]) for name in FIELDS]), 256))


def combined(digests: Column) -> Column:
    """H of digests, which lie one after another in a binary column."""
    return F.unhex(hexed_hash(digests))


def hexed_hash(digests: Column) -> Column:
    return F.sha2(F.lower(F.hex(digests)), 256)


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def tampered_rows() -> Column:
    """The rows whose text is tampered with: 3 divides the crc32 of the doc_id in decimal."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, lang, digest, and current: the digest after tampering, if it changed."""
    fields = {name: F.col(name) for name in FIELDS}
    after = F.when(tampered_rows() & (lowered(F.col("text")) != F.col("text")), leaf_hash(fields | {"text": lowered(F.col("text"))}))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), leaf_hash(fields).alias("digest"), after.alias("current"))


def joined(digests: Column) -> Column:
    """An array of digests as one binary value."""
    return F.aggregate(digests, F.lit(b""), lambda acc, x: F.concat(acc, x))


def beside(digests: Column, k: Column) -> tuple[Column, Column]:
    """The digests of a run before its place ``k`` (from 0), and those after it."""
    return joined(F.slice(digests, F.lit(1), k)), joined(F.slice(digests, k + 2, F.lit(ARITY)))


def placed(rows: DataFrame, tree: str, order: list[Column], name: str) -> DataFrame:
    """``rows``, staged, with ``pos``, the place from 0 among the rows of the same ``tree`` in ``order``, and ``n``, how many those are.

    The last sorting key is a random one, so equal rows don't share a task.
    """
    spark = rows.sparkSession
    given = stage(rows.withColumn("_salt", F.rand(7)), f"{name}-given")
    tasks = max(-(-given.count() // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(tree).asc_nulls_first(), *order, F.col("_salt").asc()]
    ordered = given.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    table = stage(ordered.withColumn("_at", F.monotonically_increasing_id()).drop("_salt"), name)
    part = F.shiftright("_at", 33).alias("_part")
    counts = table.groupBy(F.col(tree).alias("_tree"), part).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy("_tree")  # one row for each task that holds the tree
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = stage(counts.select("_tree", "_part", shift.alias("_shift"), F.sum("_n").over(whole).alias("n")), f"{name}-starts")
    same = table[tree].eqNullSafe(starts["_tree"]) & (F.shiftright(table["_at"], 33) == starts["_part"])
    return table.join(starts, same).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_tree", "_part", "_shift")


def runs_of(rows: DataFrame, *more: str) -> DataFrame:
    """``ARITY`` neighbours a row: tree, n (nodes of the tree at this level), up (the parent's place) and run, in order."""
    run = F.sort_array(F.collect_list(F.struct("pos", "digest", *more)))
    return rows.groupBy("tree", "n", F.floor(F.col("pos") / ARITY).cast("long").alias("up")).agg(run.alias("run"))


def levels_of(rows: DataFrame, name: str, *more: str) -> list[DataFrame]:
    """The runs of each level, from the leaves (tree, n, pos, digest) up, each staged.  A tree ends in its only run."""
    most = rows.agg(F.max("n")).first()[0] or 0
    levels = [stage(runs_of(rows, *more), f"{name}-runs")]
    while most > ARITY:  # as many turns as the logarithm of the largest tree
        above = levels[-1].where(F.col("n") > ARITY).select("tree", F.ceil(F.col("n") / ARITY).cast("long").alias("n"), F.col("up").alias("pos"), parent_digest().alias("digest"))
        levels.append(stage(runs_of(above), f"{name}-runs"))
        most = -(-most // ARITY)
    return levels


def parent_digest() -> Column:
    """Of a run: its hash; a node that is alone in its tree stands for itself."""
    digests = F.col("run.digest")
    return F.when(F.col("n") == 1, F.get(digests, 0)).otherwise(combined(joined(digests)))


def last_nodes(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the last node of each tree."""
    return union([runs.where(F.col("n") <= ARITY).select("tree", parent_digest().alias("digest")) for runs in levels])


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def node(tree: Column, level: int, pos: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), F.lit(level).alias("level"), pos.cast("long").alias("pos"))


def parent(level: int) -> Column:
    """The node above a run.  The last node of a language's tree is the leaf of the top tree at the tree's number."""
    ends = (F.col("n") <= ARITY) & (F.col("tree") != TOP)
    return F.when(ends, node(F.lit(TOP), 0, F.col("tree"))).otherwise(node(F.col("tree"), level + 1, F.col("up")))


def node_rows(runs: DataFrame, level: int) -> DataFrame:
    """The parent-linked rows of a level: id, parent, and the digests of the siblings left and right."""
    rows = runs.where(F.col("n") > 1).select("tree", parent(level).alias("parent"), F.col("run.digest").alias("run"), F.posexplode("run.pos").alias("k", "pos"))
    left, right = beside(F.col("run"), F.col("k"))
    return rows.select(node(F.col("tree"), level, F.col("pos")).alias("id"), "parent", left.alias("left"), right.alias("right"))


def start_rows(runs: DataFrame) -> DataFrame:
    """A row of the climb for each run of leaves: at, tree, proof (empty yet), and of each leaf its digest and folded hash."""
    def leaf(x: Column, k: Column) -> Column:
        left, right = beside(F.col("run.digest"), k)
        now = F.coalesce(x["current"], x["digest"])
        folded = F.when(F.col("n") == 1, now).otherwise(combined(F.concat(left, now, right)))
        return F.struct(x["doc_id"].alias("doc_id"), x["digest"].alias("digest"), folded.alias("folded"))

    return runs.select(parent(0).alias("at"), "tree", F.lit(b"").alias("proof"), F.transform("run", leaf).alias("leaves"))


#: The recursive query.  ``done``: the row has left the levels of ``nodes``.
CLIMB = """
    with recursive climb(at, tree, proof, leaves) as (
        select at, tree, proof, leaves from {start}
        union all
        select n.parent, c.tree, concat(c.proof, n.left, n.right),
               transform(c.leaves, x -> named_struct('doc_id', x.doc_id, 'digest', x.digest, 'folded',
                          unhex(sha2(lower(hex(concat(n.left, x.folded, n.right))), 256))))
        from climb c join {nodes} n on c.at = n.id)
    select at, tree, proof, leaves from climb
    where case when at.tree = %(top)d then at.level >= {top_cut} else at.level >= {cut} end""" % {"top": TOP}


def climb(start: DataFrame, nodes: DataFrame, cut: int, top_cut: int, small: bool) -> DataFrame:
    """The rows of ``start`` once they stand at level ``cut`` or above (``top_cut``: of the top tree), staged.

    ``nodes`` holds all nodes below those levels; ``small``: few enough of them to broadcast.
    """
    spark = start.sparkSession
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    try:
        for k, v in LIMITS.items():
            spark.conf.set(k, v)
        return stage(spark.sql(CLIMB, start=start, nodes=F.broadcast(nodes) if small else nodes, cut=cut, top_cut=top_cut), "climbed")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class Manifest:
    """A built manifest: ``root`` (None of an empty table), ``subroots`` (lang, tree, digest), and the written levels."""

    def __init__(self, docs: DataFrame, upper_nodes: int = UPPER_NODES):
        leaves = placed(hashed(docs), "lang", [F.col("doc_id").asc_nulls_first(), F.col("digest").asc()], "leaves")
        langs = placed(leaves.select("lang").distinct().withColumn("top", F.lit(TOP)), "top", [F.col("lang").asc_nulls_first()], "languages")
        langs = stage(langs.select(F.col("lang").alias("_lang"), F.col("pos").alias("tree"), F.col("n").alias("trees")), "trees")
        own = leaves.join(langs, leaves["lang"].eqNullSafe(langs["_lang"])).drop("_lang", "lang", "trees")
        self.levels = levels_of(own, "language", "doc_id", "current")
        ends = last_nodes(self.levels).join(langs, "tree")
        self.subroots = stage(ends.select(F.col("_lang").alias("lang"), "tree", "trees", "digest"), "subroots")
        top = self.subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("trees").alias("n"), F.col("tree").alias("pos"), "digest")
        self.top_levels = levels_of(top, "top")
        last = last_nodes(self.top_levels[-1:]).first()
        self.root = bytes(last["digest"]) if last else None
        rows = [(False, k, node_rows(runs, k)) for k, runs in enumerate(self.levels) if k] + [(True, k, node_rows(runs, k)) for k, runs in enumerate(self.top_levels)]
        written = [(is_top, k, stage(r, "nodes")) for is_top, k, r in rows]
        self.height = sum(is_top and not r.isEmpty() for is_top, _, r in written)  # of the top tree
        room, self.high, self.low = upper_nodes, [], []
        for is_top, k, r in reversed(written):
            room -= r.count()
            (self.low if room < 0 else self.high).append((is_top, k, r))

    def proofs(self) -> DataFrame:
        """tree, doc_id, digest, siblings (all up to the root, in order) and folded, one row a leaf."""
        rows, never = start_rows(self.levels[0]), 1 << 30
        if self.low:
            tops, langs = ([k for is_top, k, _ in self.low if is_top is t] for t in (True, False))
            cut = never if tops or len(langs) == len(self.levels) - 1 else max(langs) + 1
            rows = climb(rows, union([r for _, _, r in self.low]), cut, max(tops) + 1 if tops else 0, False)
        if self.high:
            rows = climb(rows, union([r for _, _, r in self.high]), never, self.height, True)
        each = rows.select("tree", "proof", F.col("leaves.digest").alias("run"), F.posexplode("leaves").alias("k", "x"))
        return each.select("tree", "x.doc_id", "x.digest", F.concat(*beside(F.col("run"), F.col("k")), "proof").alias("siblings"), "x.folded")


def op13(docs: DataFrame) -> DataFrame:
    """The registered query."""
    built = Manifest(docs)
    root, text = F.lit(built.root.hex() if built.root else None).cast("string"), lambda c: F.lower(F.hex(c))
    subroots = built.subroots.select("tree", F.col("digest").alias("subroot"))
    return built.proofs().join(subroots, "tree").select(
        "doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"), hexed_hash(F.col("siblings")).alias("proof_sha256"),
        text("folded").alias("folded_root"), (text("folded") == root).alias("verified"))
