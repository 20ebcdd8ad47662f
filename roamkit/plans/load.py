"""Staged-load data work (L01-L09), set-wise over landing, audit and run-log tables.

A scheduler runs these checks one scalar at a time per source; here each is a
DataFrame over *all* sources (or all runs) at once.  Nothing is collected to the
driver.  ``StagedLoad`` chains them into one load that writes its tables: next
partitions, build, gate, publish, audit, each step written under the run's id, so
that a run that died is called again and goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roamkit.config import LoadConfig
from roamkit.functions import scalars as S
from roamkit.operators import aggs as A
from roamkit.operators import joins as J

SOURCE = "source_table_name"
PARTITION = "partition_year_month_day"
GATE_STATES = ("running", "failed", "success")

# The texts of the audit ledger.
NOTHING_LOADED = "Number of affected rows: 0"
MISMATCH_LOG = ("ERROR : Staging Table Count ", " is greater than Build table count ")


# L01 / L09 -----------------------------------------------------------------------
def next_partition(landing: DataFrame, audit: DataFrame, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """Per source: the latest landing partition not yet in the audit ledger.

    The audit test is ``NOT IN (SELECT PARTITION_VAL ... WHERE source = s)`` per
    source, so a NULL PARTITION_VAL for a source hides all of that source's
    partitions.  Sources with nothing new get the sentinel date, also configured
    ones without any landing row.  A configured date (manual run) replaces
    discovery for the configured sources.
    """
    if cfg.sources:
        sources = landing.sparkSession.createDataFrame([(s,) for s in dict.fromkeys(cfg.sources)], "source string")
    else:
        sources = landing.select(F.col(SOURCE).alias("source")).distinct()
    if cfg.date is not None:
        return sources.select("source", F.lit(cfg.date).alias("partition_value"))
    land = landing.select(F.col(SOURCE).alias("source"), S.date_text(PARTITION).alias("d")).distinct()
    aud = audit.select(F.col("SOURCE_TABLE_NAME").alias("source"), F.col("PARTITION_VAL").alias("v"))
    stats = aud.groupBy("source").agg(F.count(F.lit(1)).alias("__n"),
                                      F.count_if(F.col("v").isNull()).alias("__n_null"))
    audited = aud.where(F.col("v").isNotNull()).distinct()
    fresh = land.join(audited, (land["source"] == audited["source"]) & (land["d"] == audited["v"]), "left_anti")
    fresh = J.lookup(fresh, stats, {"source": "source"}, {"__n": "__n", "__n_null": "__n_null"})
    fresh = fresh.where(F.col("__n").isNull() | ((F.col("__n_null") == 0) & F.col("d").isNotNull()))
    latest = fresh.groupBy("source").agg(F.max("d").alias("__d"))
    out = J.lookup(sources, latest, {"source": "source"}, {"__d": "__d"})
    return out.select("source", F.coalesce(F.col("__d"), F.lit(cfg.sentinel)).alias("partition_value"))


# S05 with L04 / L05 ----------------------------------------------------------------
def partition_rows(landing: DataFrame, partitions: DataFrame, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """The landing rows of each source's next partition; sources at the sentinel have none.

    The landing table is joined on its own partition column, uncast, to the small
    table of partitions, so that Spark prunes the partitions it reads at run time.
    A partition column of another type than date or text is compared by its date.
    """
    kind = landing.schema[PARTITION].dataType
    todo = partitions.where(F.col("partition_value") != cfg.sentinel)
    if isinstance(kind, T.StringType):
        day, value = F.col(PARTITION), F.col("partition_value")
    else:
        day = F.col(PARTITION) if isinstance(kind, T.DateType) else F.to_date(PARTITION)
        value = F.try_to_date("partition_value", "yyyy-MM-dd")
    todo = J.bounded_broadcast(todo.select(F.col("source").alias("__source"), value.alias("__day")))
    return landing.join(todo, (day == F.col("__day")) & (F.col(SOURCE) == F.col("__source"))).drop("__source", "__day")


# L02 -------------------------------------------------------------------------------
def count_gate(build: DataFrame, published: DataFrame, source_col: str = SOURCE) -> DataFrame:
    """Per source: build and published row counts; publish only if the build has more.

    Counts are compared as integers (a text comparison would put '9' above '10').
    """
    b = build.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("build_n"))
    p = published.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("published_n"))
    g = b.join(p, "source", "full_outer")
    g = g.select("source", F.coalesce("build_n", F.lit(0)).alias("build_n"),
                 F.coalesce("published_n", F.lit(0)).alias("published_n"))
    return g.withColumn("publish", F.col("build_n") > F.col("published_n"))


# L03 -------------------------------------------------------------------------------
def publish_if_gated(build: DataFrame, published: DataFrame, gate: DataFrame, source_col: str = SOURCE) -> DataFrame:
    """The published table after the gate: gated sources take their build rows."""
    go = gate.where(F.col("publish")).select(F.col("source").alias(source_col))
    stay = gate.where(~F.col("publish")).select(F.col("source").alias(source_col))
    return build.join(go, source_col, "left_semi").unionByName(published.join(stay, source_col, "left_semi"))


# L04 / L05 -----------------------------------------------------------------------------
AUDIT_COLUMNS = ("SOURCE_TABLE_NAME", "DAG_NAME", "DAG_RUN_ID", "SCRIPT_LOG", "START_DATE_TIME", "END_DATE_TIME",
                 "TARGET_TABLE_NAME", "SOURCE_COUNT", "TARGET_COUNT", "STATUS", "LOGS", "PARTITION_VAL")


def load_task(loaded: Column, source: Column, cfg: LoadConfig) -> Column:
    """The task that stands for a source's outcome in the run log: its load, or its refusal."""
    return F.concat(F.when(loaded, F.lit(cfg.load_task)).otherwise(F.lit(cfg.skip_task)), source)


def run_date(run_id: Column) -> Column:
    """A run's execution date as the run log writes it, from the id ``<kind>__<date>T<time>+<offset>``."""
    return S.before_first(F.replace(F.regexp_replace(run_id, "^.*?__", ""), F.lit("T"), F.lit(" ")), "+")


def audit_rows(gate: DataFrame, partitions: DataFrame, source_counts: DataFrame, target_counts: DataFrame, runs: DataFrame,
               run_id: str, cfg: LoadConfig = LoadConfig(), target_prefix: str = "staging.") -> DataFrame:
    """One 12-column audit row per source of ``gate``, success or count-mismatch.

    ``source_counts`` (source, source_n): landing rows of the loaded partition;
    ``target_counts`` (source, target_n): rows of the target after the load.  The
    times and the state are those of this run's load task, or of its do-not-load
    task where the gate refused; END_DATE_TIME is the task's end time.
    """
    now = run_status(runs).where((F.col("dag_id") == cfg.flow) & (F.col("execution_date") == run_date(F.lit(run_id))))
    df = gate.withColumn("task_id", load_task(F.col("publish"), F.col("source"), cfg))
    df = J.lookup(df, partitions, {"source": "source"}, {"partition_value": "partition_value"})
    df = J.lookup(df, source_counts, {"source": "source"}, {"source_n": "source_n"})
    df = J.lookup(df, target_counts, {"source": "source"}, {"target_n": "target_n"})
    df = J.lookup(df, now, {"task_id": "task_id"}, {"start_date": "start_date", "end_date": "end_date", "state": "state"})
    ok = F.col("publish")
    mismatch_log = F.concat(F.lit(MISMATCH_LOG[0]), F.col("published_n").cast("string"),
                            F.lit(MISMATCH_LOG[1]), F.col("build_n").cast("string"))
    return df.select(
        F.col("source").alias("SOURCE_TABLE_NAME"), F.lit(cfg.flow).alias("DAG_NAME"), F.lit(run_id).alias("DAG_RUN_ID"),
        F.when(ok, F.concat(F.lit(cfg.job_prefix), F.col("source"))).otherwise(F.lit(NOTHING_LOADED)).alias("SCRIPT_LOG"),
        F.col("start_date").alias("START_DATE_TIME"), F.col("end_date").alias("END_DATE_TIME"),
        F.concat(F.lit(target_prefix), F.col("source")).alias("TARGET_TABLE_NAME"),
        F.coalesce("source_n", F.lit(0)).alias("SOURCE_COUNT"), F.coalesce("target_n", F.lit(0)).alias("TARGET_COUNT"),
        F.when(ok, F.col("state")).otherwise(F.lit("failed")).alias("STATUS"),
        F.when(ok, F.lit(cfg.success_log)).otherwise(mismatch_log).alias("LOGS"),
        F.col("partition_value").alias("PARTITION_VAL"))


# L06 / L07 / L08 ---------------------------------------------------------------------
def run_status(runs: DataFrame, audit: DataFrame | None = None, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """Start, end and state per (flow, task, run): the latest attempt of each task instance.

    With ``audit``: those of each audit row's load (or do-not-load) task in its run,
    NULL where the run log has none.
    """
    r = runs.withColumn("execution_date", S.before_first("execution_date", "+"))
    status = A.latest(r, ["dag_id", "task_id", "execution_date"], "start_date") \
        .select("dag_id", "task_id", "execution_date", "start_date", "end_date", "state")
    if audit is None:
        return status
    a = audit.select(F.col("SOURCE_TABLE_NAME").alias("source"), F.col("DAG_NAME").alias("dag_id"), F.col("DAG_RUN_ID").alias("run_id"),
                     load_task(~F.col("SCRIPT_LOG").eqNullSafe(NOTHING_LOADED), F.col("SOURCE_TABLE_NAME"), cfg).alias("task_id"),
                     run_date(F.col("DAG_RUN_ID")).alias("execution_date"))
    return a.join(status, ["dag_id", "task_id", "execution_date"], "left")


def failed_count(runs: DataFrame) -> DataFrame:
    """Failed task instances per (flow, run); a run fails when any task failed."""
    r = runs.withColumn("execution_date", S.before_first("execution_date", "+"))
    g = r.groupBy("dag_id", "execution_date").agg(F.count_if(F.col("state") == "failed").alias("failed_tasks"))
    return g.withColumn("run_failed", F.col("failed_tasks") != 0)


def previous_run_gate(runs: DataFrame) -> DataFrame:
    """For every run: may it start, judged on the latest earlier run of its flow.

    Latest earlier run in state running / failed / success: running or failed
    blocks (poll 0), success lets it start (poll 1), with a message naming that
    run.  No earlier run at all: poll 1, first run.  Earlier runs only in other
    states: no row.  Rows of one flow and execution date are one run, in the state
    of theirs that blocks most (running, failed, success, others); so only strictly
    earlier runs count.

    A flow's last gated run is carried forward in two levels: over its days (one row
    each), then over the runs of a day, so a flow with most of the runs is spread over
    as many tasks as it has days.
    """
    ex = S.before_first("execution_date", "+").alias("execution_date")
    weight = F.coalesce(F.array_position(F.array(*map(F.lit, GATE_STATES)), F.col("state")), F.lit(0))
    state = F.min_by("state", F.when(weight > 0, weight).otherwise(F.lit(len(GATE_STATES) + 1))).alias("state")
    r = runs.groupBy("dag_id", ex).agg(state)
    # The day is a prefix of the date's text, so it sorts as the text does.
    r = r.withColumn("__day", F.substring("execution_date", 1, 10))
    gated = F.when(F.col("state").isin(*GATE_STATES), F.struct("execution_date", "state"))
    days = r.groupBy("dag_id", "__day").agg(F.max_by(gated, F.when(gated.isNotNull(), F.col("execution_date"))).alias("__last"), F.count(F.lit(1)).alias("__n"))
    earlier_days = Window.partitionBy("dag_id").orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(F.col("dag_id").alias("__dag"), F.col("__day").alias("__of"), F.last("__last", ignorenulls=True).over(earlier_days).alias("__before"),
                       F.coalesce(F.sum("__n").over(earlier_days), F.lit(0)).alias("__n_before"))
    that_day = Window.partitionBy("dag_id", "__day").orderBy("execution_date").rowsBetween(Window.unboundedPreceding, -1)
    r = r.select("dag_id", "execution_date", "__day", F.last(gated, ignorenulls=True).over(that_day).alias("__same_day"), F.count(F.lit(1)).over(that_day).alias("__n_same"))
    r = r.join(days, r["dag_id"].eqNullSafe(days["__dag"]) & r["__day"].eqNullSafe(days["__of"]))
    r = r.select("dag_id", "execution_date", F.coalesce("__same_day", "__before").alias("__prev"), (F.col("__n_same") + F.col("__n_before")).alias("__earlier"))
    prev_state = F.col("__prev.state")
    log = F.concat(F.lit("DAG "), F.col("dag_id"), F.lit(" with execution_date "), F.col("__prev.execution_date"),
                   F.lit(" is in "), prev_state, F.lit(" state."))
    out = r.where(F.col("__prev").isNotNull() | (F.col("__earlier") == 0))
    return out.select(
        "dag_id", "execution_date",
        F.when(F.col("__prev").isNull(), F.lit(1)).when(prev_state.isin("running", "failed"), F.lit(0))
        .otherwise(F.lit(1)).alias("poll"),
        F.when(F.col("__prev").isNull(), F.lit("File is being processed for the first time")).otherwise(log)
        .alias("log"))


# The load, end to end -----------------------------------------------------------------
class StagedLoad:
    """A load of all sources into the tables under ``root``, restartable by its run id.

    ``published`` and every run's ``build`` are Parquet tables partitioned by source,
    ``audit`` is partitioned by run.  Publishing replaces the partitions of the gated
    sources alone (dynamic partition overwrite), so the others' rows are neither read
    nor moved, and doing it again gives the same table.  So does the audit, which
    replaces the run's own partition.  What later steps depend on (next partitions,
    build, gate, counts) is written once a run under ``runs/<run id>``; a run called
    again reads the committed steps back, above all the gate, which would refuse a
    build that is already published.
    """

    def __init__(self, spark: SparkSession, root: str, cfg: LoadConfig = LoadConfig()):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg

    # -- tables ------------------------------------------------------------------------
    def published(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/published")

    def audit(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/audit").select(*AUDIT_COLUMNS)

    def seed(self, published: DataFrame, audit: DataFrame) -> None:
        """First content of the tables, from those of an earlier system."""
        published.write.mode("errorifexists").partitionBy(SOURCE).parquet(f"{self.root}/published")
        audit.select(*AUDIT_COLUMNS).repartition("DAG_RUN_ID").write.mode("errorifexists").partitionBy("DAG_RUN_ID").parquet(f"{self.root}/audit")

    # -- steps -------------------------------------------------------------------------
    def committed(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def step(self, run_id: str, name: str, make: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        """The rows of a step: read back if the run has committed it, else made and written.

        A partitioned step without rows has no file to take a schema from, so it has
        that of ``make()``, which must be lazy then.
        """
        path = f"{self.root}/runs/{run_id.replace(':', '-')}/{name}"
        df = make() if by or not self.committed(path) else None
        if not self.committed(path):
            writer = df.write.mode("overwrite")
            (writer.partitionBy(by) if by else writer).parquet(path)
        return (self.spark.read.schema(df.schema) if by else self.spark.read).parquet(path)

    def replace_partitions(self, df: DataFrame, table: str, by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(f"{self.root}/{table}")

    # -- the chain ---------------------------------------------------------------------
    def run(self, landing: DataFrame, runs: DataFrame, build: Callable[[DataFrame, DataFrame], DataFrame], run_id: str) -> DataFrame:
        """Load every source with a new partition; the audit rows of this run.

        ``build(partitions, rows)`` makes the new content of the sources in
        ``partitions`` (source, partition_value), given the landing rows of those
        partitions.  Sources without a new partition (the sentinel) are neither built
        nor gated, and leave no audit row.
        """
        cfg, source = self.cfg, F.col(SOURCE).alias("source")
        parts = self.step(run_id, "partitions", lambda: next_partition(landing, self.audit(), cfg))
        todo = parts.where(F.col("partition_value") != cfg.sentinel)
        fresh = partition_rows(landing, parts, cfg)
        sources = J.bounded_broadcast(todo.select(F.col("source").alias(SOURCE)))
        built = self.step(run_id, "build", lambda: build(todo, fresh).join(sources, SOURCE, "left_semi"), by=SOURCE)
        gate = self.step(run_id, "gate", lambda: count_gate(built, self.published().join(sources, SOURCE, "left_semi")))
        go = J.bounded_broadcast(gate.where("publish").select(F.col("source").alias(SOURCE)))

        def publish_and_count() -> DataFrame:
            self.publish(built.join(go, SOURCE, "left_semi"))
            return self.published().join(sources, SOURCE, "left_semi").groupBy(source).agg(F.count(F.lit(1)).alias("target_n"))

        target = self.step(run_id, "target_counts", publish_and_count)
        counted = fresh.groupBy(source).agg(F.count(F.lit(1)).alias("source_n"))
        rows = self.step(run_id, "audit", lambda: audit_rows(gate, parts, counted, target, runs, run_id, cfg))
        self.replace_partitions(rows, "audit", "DAG_RUN_ID")
        return rows

    def publish(self, rows: DataFrame) -> None:
        """S06 of the gated sources."""
        self.replace_partitions(rows, "published", SOURCE)


def run_load(spark: SparkSession, root: str, landing: DataFrame, runs: DataFrame, build: Callable[[DataFrame, DataFrame], DataFrame],
             run_id: str, cfg: LoadConfig = LoadConfig()) -> DataFrame:
    """One staged load of all sources (see ``StagedLoad``); the audit rows of the run."""
    return StagedLoad(spark, root, cfg).run(landing, runs, build, run_id)
