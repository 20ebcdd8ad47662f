"""Table reads and writes.

A replace writes a fresh directory ``<root>/<name>/v<number>-<id>``, numbered one
above those there, and the table is the last committed one (Spark's ``_SUCCESS``
marker is written at job commit).  So a rebuild never overwrites files that the
same job is reading, a failed write leaves the old content current, and a
previous-run snapshot is a small reference file (written aside, then renamed) to
the directory it stands for.  ``vacuum`` deletes what is neither current nor
referred to.  An append is keyed by its run: it replaces the run's partition, so
a retried append leaves the rows once.
Storage is whatever filesystem the root lives on (the cluster's shared
``spark.checkpoint.dir`` by default), reached through Hadoop's FileSystem API.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamkit.operators.sets import literal_row  # noqa: F401  (S07 lives with the set operators)
from roamkit.session import checkpoint_dir


#: Column of a ledger that says which run added a row; it is the partition column and not part of the rows.
RUN = "_run"


def read_table(spark: SparkSession, name: str, locations: Mapping[str, str] | None = None) -> DataFrame:
    """A named table: a configured Parquet location, else the session catalog."""
    if locations and name in locations:
        return spark.read.parquet(locations[name])
    return spark.table(name)


class TableStore:
    """Versioned and append-only tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{checkpoint_dir(spark)}/roamkit_tables").rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- helpers -------------------------------------------------------------
    def _p(self, *parts: str):
        return self._Path("/".join([self.root, *parts]))

    def _versions(self, name: str) -> list[str]:
        d = self._p(name)
        if not self._fs.exists(d):
            return []
        out = []
        for st in self._fs.listStatus(d):
            n = st.getPath().getName()
            if n.startswith("v") and (n.endswith(".ref") or self._fs.exists(self._p(name, n, "_SUCCESS"))):
                out.append(n)
        return sorted(out)

    def current_path(self, name: str) -> str | None:
        versions = self._versions(name)
        if not versions:
            return None
        return self._path(name, versions[-1])

    def _path(self, name: str, version: str) -> str:
        if not version.endswith(".ref"):
            return "/".join([self.root, name, version])
        stream = self._fs.open(self._p(name, version))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def _new_version(self, name: str) -> str:
        """One above every directory and reference there is, committed or not."""
        d = self._p(name)
        names = [st.getPath().getName() for st in self._fs.listStatus(d)] if self._fs.exists(d) else []
        last = max((int(n[1:].split("-")[0]) for n in names if n.startswith("v")), default=0)
        return f"v{last + 1:020d}-{uuid.uuid4().hex[:8]}"

    # -- S01 / S02 / S03 -----------------------------------------------------
    def exists(self, name: str) -> bool:
        return self.current_path(name) is not None

    def read(self, name: str) -> DataFrame:
        path = self.current_path(name)
        if path is None:
            raise FileNotFoundError(f"table {name!r} has no committed version under {self.root}")
        return self.spark.read.parquet(path)

    def replace(self, df: DataFrame, name: str) -> DataFrame:
        """Create-or-replace ``name`` as ``df``; returns the new version."""
        path = "/".join([self.root, name, self._new_version(name)])
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.parquet(path)

    def replace_bucketed(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """S02 of a ledger kept in buckets of its key, so that a join with it on ``keys`` shuffles the other side only.

        New rows should come with the old ones unshuffled (as ``merge_ledger`` gives them):
        a task then writes the buckets that it holds.
        """
        path = "/".join([self.root, name, f"{self._new_version(name)}-b{buckets}"])
        df.write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(self._ident(path))
        return self.spark.table(self._ident(path))

    def read_bucketed(self, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
        """The table with its buckets known to the planner; one written otherwise is read plainly."""
        path = self.current_path(name)
        if path is None or not path.endswith(f"-b{buckets}"):
            return self.read(name)
        if not self.spark.catalog.tableExists(self._ident(path)):  # written by another session
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            by = ", ".join(f"`{k}`" for k in keys)
            self.spark.sql(f"create table {self._ident(path)} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'")
        return self.spark.table(self._ident(path))

    @staticmethod
    def _ident(path: str) -> str:
        return f"roamkit_{hashlib.sha1(path.encode()).hexdigest()[:20]}"

    def snapshot(self, name: str, to: str | None = None) -> DataFrame | None:
        """Make ``<name>_prev`` (or ``to``) the current version of ``name``.

        Versions are immutable, so the snapshot is a reference, written before
        the rebuild.  Returns the snapshot, or None when ``name`` does not exist.
        """
        src = self.current_path(name)
        if src is None:
            return None
        target = to or f"{name}_prev"
        ref = self._new_version(target) + ".ref"
        aside = self._p(target, f".{ref}")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(src.encode("utf-8")))
        finally:
            out.close()
        self._fs.rename(aside, self._p(target, ref))
        return self.spark.read.parquet(src)

    def vacuum(self, names: list[str]) -> list[str]:
        """Delete what is no longer current of ``names``; returns the deleted paths.

        Kept are each table's current directory and those that the current reference
        of any table under the root points to.  Call it when no job reads old content.
        """
        tables = [st.getPath().getName() for st in self._fs.listStatus(self._p())] if self._fs.exists(self._p()) else []
        kept = {path for t in tables if (path := self.current_path(t))}
        gone = []
        for name in names:
            current = (self._versions(name) or [None])[-1]
            number = lambda v: int(v[1:].split("-")[0])
            entries = self._fs.listStatus(self._p(name)) if self._fs.exists(self._p(name)) else []
            for n in [st.getPath().getName() for st in entries]:
                path = "/".join([self.root, name, n])
                old = n.startswith("v") and current is not None and n != current and number(n) < number(current)
                if old and path not in kept:
                    self._fs.delete(self._p(name, n), True)
                    gone.append(path)
        return gone

    # -- S04 / S05 / S06 -----------------------------------------------------
    def append(self, df: DataFrame, name: str, run_id: str) -> None:
        """Add the rows of a run to a ledger; the same run again replaces them."""
        df.withColumn(RUN, F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(RUN).parquet("/".join([self.root, name, "data"]))

    def read_appended(self, name: str) -> DataFrame:
        return self.spark.read.parquet("/".join([self.root, name, "data"])).drop(RUN)

    def publish(self, name: str, build_suffix: str = "_t01") -> DataFrame:
        """Replace ``name`` with its build table ``<name>_t01``."""
        return self.replace(self.read(name + build_suffix), name)


def read_partition(df: DataFrame, partition_col: str, value) -> DataFrame:
    """The rows of one partition; on a partitioned scan this is a PartitionFilter."""
    return df.where(F.col(partition_col) == F.lit(value))
