"""Helpers the operators share: staged tables and files in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roamkit.session import checkpoint_dir

#: The Spark application that has this package already.
SHIPPED: dict[str, str] = {}


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of the cluster (see ``checkpoint_dir``)."""
    base = checkpoint_dir(spark)
    return f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/roamkit_llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there.

    The files outlive executors, so a lost executor costs at most its running tasks.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``stage``, bucketed and sorted by ``key``: joins and groupings on it shuffle only what they meet.

    The rows are dealt by the hash of ``key`` to as many buckets as a shuffle has partitions.  The
    table is external, under the shared folder; ``forget`` takes it out of the catalog.
    """
    spark = df.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), run_dir(spark, name)
    table = f"roamkit_llm_{path.rsplit('-', 1)[1]}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def forget(*tables: DataFrame) -> None:
    """Take tables of ``stage_by`` out of the catalog; their files stay."""
    for t in tables:
        for f in t.inputFiles()[:1]:
            t.sparkSession.sql(f"drop table if exists roamkit_llm_{f.rsplit('/', 2)[1].rsplit('-', 1)[1]}")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    A lambda variable is bound once a row; a plain column used inside another
    lambda may be inlined there and evaluated for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system of ``uri`` (local, HDFS, S3, GCS) and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def documents_of(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession, rows: int = 500) -> None:
    """Prepare Python workers: they can import this package, and get texts a few hundred at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    here = Path(__file__).resolve().parents[1]
    if SHIPPED.get("app") != spark.sparkContext.applicationId:
        package = Path(tempfile.mkdtemp()) / f"{here.name}.zip"  # Spark copies it to the executors
        with zipfile.ZipFile(package, "w") as z:
            for p in sorted(here.rglob("*.py")):
                z.write(p, p.relative_to(here.parent))
        spark.sparkContext.addPyFile(str(package))
        SHIPPED["app"] = spark.sparkContext.applicationId
