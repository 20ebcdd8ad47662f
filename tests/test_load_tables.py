import datetime as dt

import pytest
from pyspark.sql import functions as F

from roamkit.config import LoadConfig
from roamkit.plans import load as L
from roamkit.sources.tables import TableStore, read_partition
from row_helpers import rows

D = dt.date


def _landing(spark, data):
    return spark.createDataFrame(data, "source_table_name string, partition_year_month_day date")


def _audit(spark, data):
    return spark.createDataFrame(data, "SOURCE_TABLE_NAME string, PARTITION_VAL string")


def test_next_partition_cases(spark):
    land = _landing(spark, [("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("b", D(2024, 1, 1)), ("c", D(2024, 1, 5)),
                            ("d", D(2024, 1, 7))])
    audit = _audit(spark, [("a", "2024-01-01"), ("b", "2024-01-01"), ("c", None), ("c", "2024-01-04")])
    got = dict(rows(L.next_partition(land, audit)))
    assert got == {"a": "2024-01-02", "b": "9999-12-31", "c": "9999-12-31", "d": "2024-01-07"}
    manual = dict(rows(L.next_partition(land, audit, LoadConfig(sources=("a", "zz"), date="2023-12-31"))))
    assert manual == {"a": "2023-12-31", "zz": "2023-12-31"}
    listed = dict(rows(L.next_partition(land, audit, LoadConfig(sources=("a", "zz")))))
    assert listed == {"a": "2024-01-02", "zz": "9999-12-31"}


@pytest.mark.parametrize("build_n,published_n,publish", [(9, 10, False), (10, 9, True), (5, 5, False), (10, 0, True)])
def test_count_gate_integer_compare(spark, build_n, published_n, publish):
    build = spark.createDataFrame([("s",)] * build_n, "source_table_name string")
    published = spark.createDataFrame([("s",)] * published_n, "source_table_name string")
    r = L.count_gate(build, published).first()
    assert (r["build_n"], r["published_n"], r["publish"]) == (build_n, published_n, publish)


def test_publish_if_gated(spark):
    build = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source_table_name string, x int")
    published = spark.createDataFrame([("a", 9), ("b", 8), ("b", 7)], "source_table_name string, x int")
    gate = L.count_gate(build, published)
    assert rows(L.publish_if_gated(build, published, gate)) == [("a", 1), ("a", 2), ("b", 7), ("b", 8)]


RUNS = "dag_id string, task_id string, execution_date string, start_date string, end_date string, state string"


def test_previous_run_gate(spark):
    runs = spark.createDataFrame([
        ("f", "t", "2024-01-01 00:00:00+00:00", "s", "e", "success"),
        ("f", "t", "2024-01-02 00:00:00+00:00", "s", "e", "queued"),
        ("f", "t", "2024-01-03 00:00:00+00:00", "s", "e", "failed"),
        ("f", "t", "2024-01-04 00:00:00+00:00", "s", "e", "running"),
        ("g", "t", "2024-01-01 00:00:00+00:00", "s", "e", "queued"),
        ("g", "t", "2024-01-02 00:00:00+00:00", "s", "e", "success"),
    ], RUNS)
    got = {(r["dag_id"], r["execution_date"][:10]): (r["poll"], r["log"]) for r in L.previous_run_gate(runs).collect()}
    assert got[("f", "2024-01-01")] == (1, "File is being processed for the first time")
    assert got[("f", "2024-01-02")][0] == 1 and "is in success state." in got[("f", "2024-01-02")][1]
    assert got[("f", "2024-01-03")][0] == 1 and "2024-01-01 00:00:00 is in success" in got[("f", "2024-01-03")][1]
    assert got[("f", "2024-01-04")][0] == 0 and "is in failed state." in got[("f", "2024-01-04")][1]
    assert got[("g", "2024-01-01")][0] == 1
    assert ("g", "2024-01-02") not in got  # earlier runs only in other states


def test_failed_count_and_run_status(spark):
    runs = spark.createDataFrame([
        ("f", "a", "2024-01-01+00:00", "10", "11", "failed"), ("f", "a", "2024-01-01+00:00", "12", "13", "success"),
        ("f", "b", "2024-01-01+00:00", "10", "11", "failed"), ("f", "a", "2024-01-02+00:00", "10", "11", "success"),
    ], RUNS)
    assert rows(L.failed_count(runs)) == [("f", "2024-01-01", 2, True), ("f", "2024-01-02", 0, False)]
    status = rows(L.run_status(runs), "task_id", "execution_date", "start_date", "state")
    assert status == [("a", "2024-01-01", "12", "success"), ("a", "2024-01-02", "10", "success"),
                      ("b", "2024-01-01", "10", "failed")]


def test_table_store_versions_and_snapshot(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "store"))
    assert st.current_path("t") is None and st.snapshot("t") is None
    st.replace(spark.createDataFrame([(1,)], "x int"), "t")
    st.snapshot("t")
    st.replace(spark.createDataFrame([(2,), (3,)], "x int"), "t")
    assert rows(st.read("t")) == [(2,), (3,)]
    assert rows(st.read("t_prev")) == [(1,)]
    # an uncommitted (failed) write is never current
    (tmp_path / "store" / "t" / "v00000000000000000099-dead").mkdir()
    assert rows(st.read("t")) == [(2,), (3,)]
    st.replace(spark.createDataFrame([(5,)], "x int"), "t_t01")
    st.publish("t")
    assert rows(st.read("t")) == [(5,)]
    st.append(spark.createDataFrame([(1,)], "x int"), "ledger", "run1")
    st.append(spark.createDataFrame([(2,)], "x int"), "ledger", "run2")
    assert rows(st.read_appended("ledger")) == [(1,), (2,)]
    st.append(spark.createDataFrame([(2,)], "x int"), "ledger", "run2")  # a retry
    assert rows(st.read_appended("ledger")) == [(1,), (2,)]


def test_vacuum_keeps_current_and_referred(spark, tmp_path):
    st = TableStore(spark, str(tmp_path / "store"))
    for k in range(3):
        st.replace(spark.createDataFrame([(k,)], "x int"), "t")
        if k == 1:
            st.snapshot("t")
    assert len(st.vacuum(["t", "t_prev", "none"])) == 1
    assert rows(st.read("t")) == [(2,)] and rows(st.read("t_prev")) == [(1,)]
    st.snapshot("t")
    assert len(st.vacuum(["t", "t_prev"])) == 2  # the old reference and what it stood for
    assert rows(st.read("t_prev")) == [(2,)]


def test_read_partition_prunes(spark, tmp_path):
    path = str(tmp_path / "landing")
    spark.createDataFrame([("a", D(2024, 1, 1)), ("a", D(2024, 1, 2))], "s string, p date") \
        .write.partitionBy("p").parquet(path)
    df = read_partition(spark.read.parquet(path), "p", D(2024, 1, 2))
    assert rows(df) == [("a", D(2024, 1, 2))]
    assert "PartitionFilters: [isnotnull(p" in df._jdf.queryExecution().executedPlan().toString()


def test_size_shuffles(spark):
    from roamkit.session import size_shuffles
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, 10 << 40) == 40960  # 10 TiB / 256 MiB
        assert size_shuffles(spark, 1 << 20) == 200
        assert size_shuffles(spark, 100 << 40) == 409_600  # no ceiling of its own
        assert size_shuffles(spark, 1 << 60) == 2**31 - 1  # what Spark's setting can hold
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_checkpoint_dir_rules():
    from types import SimpleNamespace

    from roamkit.session import checkpoint_dir

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    unset = SimpleNamespace(isDefined=lambda: False)
    jsc = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset))
    configured = SimpleNamespace(conf=Conf("hdfs://shared/ckpt/"), sparkContext=None)
    assert checkpoint_dir(configured) == "hdfs://shared/ckpt"
    cluster = SimpleNamespace(conf=Conf(None), sparkContext=SimpleNamespace(_jsc=jsc, master="yarn"))
    with pytest.raises(RuntimeError):
        checkpoint_dir(cluster)


def test_previous_run_gate_takes_strictly_earlier_runs(spark):
    runs = spark.createDataFrame([("f", "t", "2024-01-02 00:00:00+00:00", "s", "e", "failed"),
                                  ("f", "u", "2024-01-02 00:00:00+00:00", "s", "e", "success"),
                                  ("f", "t", "2024-01-03 00:00:00+00:00", "s", "e", "success")], RUNS)
    got = rows(L.previous_run_gate(runs), "execution_date", "poll")
    assert got == [("2024-01-02 00:00:00", 1), ("2024-01-03 00:00:00", 0)]


def test_only_other_states_give_no_default_row(spark):
    from roamkit.plans.catalog import _gate_or_default
    runs = spark.createDataFrame([("f", "t", "2024-01-02 00:00:00+00:00", "s", "e", "queued")], RUNS)
    asked = lambda before: spark.createDataFrame([("f", before)], "dag_id string, before string")
    assert _gate_or_default(spark, runs, asked("2024-01-05")).collect() == []
    assert [r["poll"] for r in _gate_or_default(spark, runs, asked("2024-01-01")).collect()] == [1]


class Crash(Exception):
    pass


class Dying(L.StagedLoad):
    """A load that dies right before or after the write of one of its steps."""

    at, after = None, False

    def step(self, run_id, name, make, by=None):
        if name == self.at and not self.after:
            raise Crash(name)
        out = super().step(run_id, name, make, by)
        if name == self.at:
            raise Crash(name)
        return out

    def publish(self, rows):
        if self.at == "publish" and not self.after:
            raise Crash("publish")
        super().publish(rows)
        if self.at == "publish":
            raise Crash("publish")

    def replace_partitions(self, df, table, by):
        super().replace_partitions(df, table, by)
        if self.at == "ledger" and table == "audit":
            raise Crash("ledger")


RUN = "scheduled__2024-01-03T23:00:00+00:00"


def _load_inputs(spark):
    land = spark.createDataFrame([("a", D(2024, 1, 1), 1), ("a", D(2024, 1, 3), 2), ("a", D(2024, 1, 3), 3), ("b", D(2024, 1, 3), 4), ("c", D(2024, 1, 1), 5)],
                                 "source_table_name string, partition_year_month_day date, x int")
    published = land.where("partition_year_month_day < '2024-01-03' or source_table_name = 'b'")
    old = [("a", "old", "scheduled__2024-01-01T23:00:00+00:00", "job_a", "s", "e", "staging.a", 1, 1, "success", "ok", "2024-01-01"),
           ("c", "old", "scheduled__2024-01-01T23:00:00+00:00", "job_c", "s", "e", "staging.c", 1, 1, "success", "ok", "2024-01-01")]
    audit = spark.createDataFrame(old, ", ".join(f"{c} {'long' if c.endswith('COUNT') else 'string'}" for c in L.AUDIT_COLUMNS))
    runs = spark.createDataFrame([("staging_load", task, "2024-01-03 23:00:00+00:00", start, start + "!", state) for task, start, state in
                                  [("load_data_a", "10", "failed"), ("load_data_a", "11", "success"), ("do_not_load_a", "12", "success"), ("do_not_load_b", "13", "success")]]
                                 + [("staging_load", "load_data_a", "2024-01-04 23:00:00+00:00", "99", "99", "success")], RUNS)
    return land, published, audit, runs


def _load(spark, root, kind=L.StagedLoad, at=None, after=False, run_id=RUN):
    land, _, _, runs = _load_inputs(spark)
    load = kind(spark, str(root))
    load.at, load.after = at, after
    load.run(land, runs, lambda parts, fresh: land, run_id)
    return load


def test_staged_load(spark, tmp_path):
    _, published, audit, _ = _load_inputs(spark)
    L.StagedLoad(spark, str(tmp_path)).seed(published, audit)
    load = _load(spark, tmp_path)
    want_audit = [("a", "staging_load", RUN, "job_a", "11", "11!", "staging.a", 2, 3, "success", "Data is successfully loaded in staging", "2024-01-03"),
                  ("b", "staging_load", RUN, "Number of affected rows: 0", "13", "13!", "staging.b", 1, 1, "failed",
                   "ERROR : Staging Table Count 1 is greater than Build table count 1", "2024-01-03")]
    assert rows(load.audit().where(F.col("DAG_RUN_ID") == RUN), *L.AUDIT_COLUMNS) == want_audit
    assert rows(load.published(), "source_table_name", "x") == [("a", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 5)]
    # the same run again changes nothing; a later run finds only the sentinel: nothing built, published or audited
    for run_id in (RUN, "scheduled__2024-01-04T23:00:00+00:00"):
        again = _load(spark, tmp_path, run_id=run_id)
        assert rows(again.audit()) == rows(load.audit()) and again.audit().count() == 4
        assert rows(again.published(), "x") == [(1,), (2,), (3,), (4,), (5,)]
    assert {v for _, v in rows(L.next_partition(_load_inputs(spark)[0], load.audit()))} == {"9999-12-31"}


@pytest.fixture(scope="module")
def whole_load(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("whole")
    _, published, audit, _ = _load_inputs(spark)
    L.StagedLoad(spark, str(root)).seed(published, audit)
    load = _load(spark, root)
    return rows(load.published()), rows(load.audit())


@pytest.mark.parametrize("at,after", [("partitions", True), ("build", True), ("gate", False), ("gate", True), ("publish", False),
                                      ("publish", True), ("target_counts", True), ("audit", True), ("ledger", True)])
def test_staged_load_goes_on_after_a_crash(spark, tmp_path, whole_load, at, after):
    _, published, audit, _ = _load_inputs(spark)
    L.StagedLoad(spark, str(tmp_path)).seed(published, audit)
    with pytest.raises(Crash):
        _load(spark, tmp_path, Dying, at, after)
    load = _load(spark, tmp_path)
    assert (rows(load.published()), rows(load.audit())) == whole_load


def test_partition_rows_prunes_at_run_time(spark, tmp_path):
    days = [D(2024, 1, k) for k in range(1, 21)]
    spark.createDataFrame([(s, d, 1) for s in "ab" for d in days], "source_table_name string, partition_year_month_day date, x int") \
        .repartition("partition_year_month_day").write.partitionBy("partition_year_month_day").parquet(str(tmp_path / "landing"))
    parts = spark.createDataFrame([("a", "2024-01-20"), ("b", "9999-12-31")], "source string, partition_value string")
    parts.write.parquet(str(tmp_path / "parts"))
    got = L.partition_rows(spark.read.parquet(str(tmp_path / "landing")), spark.read.parquet(str(tmp_path / "parts")))
    assert [tuple(r) for r in got.select("source_table_name", "partition_year_month_day").collect()] == [("a", D(2024, 1, 20))]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    files = []

    def visit(p):
        name = p.getClass().getSimpleName()
        if name == "FileSourceScanExec" and "partition_year_month_day" in p.toString():
            files.append(p.metrics().apply("numFiles").value())
        children = p.children()
        for k in range(children.size()):
            visit(children.apply(k))
        if name == "AdaptiveSparkPlanExec":
            visit(p.executedPlan())
        if name.endswith("QueryStageExec"):
            visit(p.plan())

    got.collect()
    visit(got._jdf.queryExecution().executedPlan())
    assert files == [1]  # of 20


def test_run_status_of_audit_rows(spark):
    _, _, audit, runs = _load_inputs(spark)
    rows_ = audit.withColumn("DAG_NAME", F.lit("staging_load")).withColumn("DAG_RUN_ID", F.lit(RUN))
    rows_ = rows_.withColumn("SCRIPT_LOG", F.when(F.col("SOURCE_TABLE_NAME") == "a", F.lit(L.NOTHING_LOADED)).otherwise(F.col("SCRIPT_LOG")))
    assert rows(L.run_status(runs, rows_), "source", "task_id", "execution_date", "start_date", "end_date", "state") == [
        ("a", "do_not_load_a", "2024-01-03 23:00:00", "12", "12!", "success"), ("c", "load_data_c", "2024-01-03 23:00:00", None, None, None)]


def test_previous_run_gate_equals_one_pass_in_order(spark):
    """The two-level carry equals going through each flow's runs in order; a busy flow has many partitions, not one."""
    import random
    rng = random.Random(2)
    data = [(rng.choice(["busy"] * 8 + ["f", None]), "t", f"2024-0{rng.randint(1, 3)}-{rng.randint(10, 14)} {rng.randint(10, 12)}:00:00+00:00", "s", "e", rng.choice(["running", "failed", "success", "queued", None])) for _ in range(300)]
    weight = {"running": 0, "failed": 1, "success": 2}
    state = {}
    for dag, _, ex, _, _, s in data:
        key = (dag, ex[:-6])
        if key not in state or weight.get(s, 3) < weight.get(state[key], 3):
            state[key] = s
    want = []
    for dag in {k[0] for k in state}:
        last = None
        for k, ex in enumerate(sorted(e for g, e in state if g == dag)):
            if last or not k:
                want.append((dag, ex, 0 if last and state[dag, last] != "success" else 1))
            if state[dag, ex] in weight:
                last = ex
    df = L.previous_run_gate(spark.createDataFrame(data, RUNS))
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert rows(df, "dag_id", "execution_date", "poll") == sorted(want, key=key)
    assert "hashpartitioning(dag_id" in (plan := df._jdf.queryExecution().executedPlan().toString()) and "__day" in plan
