import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from roamkit.operators import aggs as A
from roamkit.operators import sets as U
from row_helpers import rows

D = dt.date


def _random_rows(n=400, seed=3):
    rnd = random.Random(seed)
    keys = ["a", "b", "c", None]
    months = ["202001", "202002", None]
    return [(rnd.choice(keys), rnd.choice(months), rnd.choice([None, float(rnd.randrange(-5, 6))]),
             D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 30)) if rnd.random() > .1 else None)
            for _ in range(n)]


SCHEMA = "k string, m string, v double, d date"


def test_latest_equals_dense_rank_with_ties_and_nulls(spark):
    df = spark.createDataFrame(_random_rows() + [("z", None, 1.0, None), ("z", None, 2.0, None)], SCHEMA)
    w = Window.partitionBy("k").orderBy(F.col("d").desc())
    want = rows(df.withColumn("r", F.dense_rank().over(w)).where("r = 1").drop("r"))
    assert rows(A.latest(df, ["k"], "d")) == want


def test_totals_and_ranks_equal_window_form(spark):
    df = spark.createDataFrame(_random_rows(), SCHEMA)
    tot = A.with_total(df, ["m", "k"], "v", "t")
    ranked = A.rank_totals(tot, ["m"], "t", "r")
    w = Window.partitionBy("m", "k")
    ref = df.withColumn("t", F.sum(F.col("v").cast("decimal(38,6)")).over(w).cast("double"))
    ref = ref.withColumn("r", F.dense_rank().over(Window.partitionBy("m").orderBy(F.col("t").asc_nulls_first())))
    assert rows(ranked, "k", "m", "v", "d", "t", "r") == rows(ref, "k", "m", "v", "d", "t", "r")
    both = A.with_totals_and_ranks(df, ["m"], "v", [("k", "t", "r")])
    assert rows(both, "k", "m", "v", "d", "t", "r") == rows(ref, "k", "m", "v", "d", "t", "r")


def test_partition_aggs_count_when(spark):
    df = spark.createDataFrame([("x", 0.5, "d1"), ("x", 0.0, "d2"), ("x", None, "d3"), ("y", 0.0, "d4")],
                               "k string, t double, d string")
    out = A.with_partition_aggs(df, ["k"], {"n": F.count(F.when(F.col("t") > 0, F.col("d")))})
    assert rows(out, "d", "n") == [("d1", 1), ("d2", 1), ("d3", 1), ("d4", 0)]


def test_rolling_avg_row_frame_with_gaps_and_duplicates(spark):
    days = [1, 2, 5, 9, 9, 10, 11, 12, 13, 20]
    data = [("p", D(2024, 1, x), float(10 * i)) for i, x in enumerate(days)]
    data[4] = ("p", D(2024, 1, 9), data[3][2])  # duplicate row (same date, same amount)
    df = spark.createDataFrame(data, "k string, d date, v double")
    got = sorted(r["a"] for r in A.rolling_avg(df, ["k"], "d", "v", "a", 6).collect())
    vals = [v for _, _, v in sorted(data, key=lambda t: t[1])]
    want = sorted(sum(vals[max(0, i - 6):i + 1]) / len(vals[max(0, i - 6):i + 1]) for i in range(len(vals)))
    assert [round(x, 9) for x in got] == [round(x, 9) for x in want]


def test_group_sum_types(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2)], "k string, n int, x double")
    r = A.group_sum(df, ["k"], ["n", "x"]).first()
    assert r["n"] == 3 and abs(r["x"] - 0.3) < 1e-12 and isinstance(r["n"], int)


def test_cutover_one_scan_equals_two_branches(spark):
    data = [(m, c) for m in ("202002", "202003", "202004", "202005", None) for c in ("MLTTL", "X", None)]
    df = spark.createDataFrame(data, "m string, c string")
    one = rows(U.cutover(df, "m", 202004, "c", ["MLTTL", "MLTMA"], as_text=True))
    two = rows(df.where("m < '202004'").unionByName(df.where("m > '202003' and c not in ('MLTTL', 'MLTMA')")))
    assert one == two
    num = spark.createDataFrame(data, "m string, c string")
    assert rows(U.cutover(num, "m", 202001, "c", ["X"])) == rows(
        num.where("cast(m as bigint) < 202001").unionByName(num.where("cast(m as bigint) > 201912 and c not in ('X')")))


def test_split_direction_keeps_null(spark):
    df = spark.createDataFrame([("a", "Bilateral"), ("b", "Inbound"), ("c", None)], "n string, d string")
    assert rows(U.split_direction(df, "d")) == [("a", "Inbound"), ("a", "Outbound"), ("b", "Inbound"), ("c", None)]


def test_merge_ledger_readds_null_key_rows(spark):
    new = spark.createDataFrame([(D(2024, 1, 2), None, 1.0), (D(2024, 1, 3), D(2023, 12, 3), 2.0),
                                 (D(2024, 1, 4), D(2023, 12, 4), 3.0)], "d date, d30 date, v double")
    prev = spark.createDataFrame([(D(2024, 1, 2), None, 1.0, "1"), (D(2024, 1, 3), D(2023, 12, 3), 2.0, "1")],
                                 "d date, d30 date, v double, latest_flag string")
    out = rows(U.merge_ledger(new, prev, ["d", "d30"]), "d", "latest_flag")
    assert out == [(D(2024, 1, 2), "0"), (D(2024, 1, 2), "1"), (D(2024, 1, 3), "0"), (D(2024, 1, 4), "1")]
    out = rows(U.merge_ledger(new, prev, ["d", "d30"], null_safe=True), "d", "latest_flag")
    assert out == [(D(2024, 1, 2), "0"), (D(2024, 1, 3), "0"), (D(2024, 1, 4), "1")]


def test_latest_or_default_and_top1(spark):
    runs = spark.createDataFrame([("r1", "2024-01-01"), ("r2", "2024-01-03")], "id string, ex string")
    default = U.literal_row(spark, id="first", ex=None).withColumn("ex", F.lit(None).cast("string"))
    assert rows(U.latest_or_default(runs, "ex", default)) == [("r2", "2024-01-03")]
    assert rows(U.latest_or_default(runs.where("false"), "ex", default)) == [("first", None)]
    assert rows(U.latest_row(runs, "ex")) == [("r2", "2024-01-03")]


def test_staged_join_backs_equal_unstaged(spark, tmp_path):
    from roamkit.sources.tables import TableStore
    st = TableStore(spark, str(tmp_path / "stage"))
    df = spark.createDataFrame(_random_rows(seed=11), SCHEMA)
    assert rows(A.latest(df, ["k"], "d", stage=st.replace)) == rows(A.latest(df, ["k"], "d"))
    assert rows(A.with_total(df, ["m", "k"], "v", "t", stage=st.replace)) == rows(A.with_total(df, ["m", "k"], "v", "t"))
    a = A.with_totals_and_ranks(df, ["m"], "v", [("k", "t", "r")], stage=st.replace)
    b = A.with_totals_and_ranks(df, ["m"], "v", [("k", "t", "r")])
    assert rows(a) == rows(b)


def test_sums_keep_digits_beyond_six(spark):
    from roamkit.operators import aggs as A
    df = spark.createDataFrame([("k", 4e-7, i) for i in range(10)] + [("big", 1e20, 0), ("none", None, 0)], "k string, x double, d int")
    got = {r["k"]: r["x"] for r in A.group_sum(df, ["k"], ["x"]).collect()}
    assert abs(got["k"] - 4e-6) < 1e-18 and got["big"] == 1e20 and got["none"] is None
    roll = A.rolling_avg(df.where("k = 'k'"), ["k"], "d", "x", "m").collect()
    assert all(abs(r["m"] - 4e-7) < 1e-18 for r in roll)
    exact = A.group_sum(df.selectExpr("k", "cast(d as decimal(20,4)) d"), ["k"], ["d"])
    assert dict(exact.dtypes)["d"].startswith("decimal")


def test_sums_have_the_same_bits_in_any_order(spark):
    """Residues below six decimals and values from 1e15 up add exactly, however rows are dealt."""
    import random

    from pyspark.sql import functions as F
    rng = random.Random(5)
    values = [rng.choice([1e-9, 1e16, 1.1, -1e16, 3e21, -3e21, 1e-20, 0.1]) * rng.random() for _ in range(3000)] + [None]
    got = set()
    for seed in range(4):
        rng.shuffle(values)
        df = spark.createDataFrame([(k % 7, v) for k, v in enumerate(values)], "k int, v double").repartition(1 + 5 * seed, F.rand(seed))
        total = A.group_sum(df.withColumn("one", F.lit(1)), ["one"], ["v"]).first()["v"]
        got.add(total.hex())
    assert len(got) == 1
    import math
    assert math.isclose(float.fromhex(got.pop()), math.fsum(v for v in values if v is not None), rel_tol=1e-12)
    edge = spark.createDataFrame([("a", None), ("b", float("nan")), ("b", 1.0), ("c", 1e300), ("c", 1.0), ("d", 0.0)], "k string, v double")
    out = {r["k"]: r["v"] for r in A.group_sum(edge, ["k"], ["v"]).collect()}
    assert out["a"] is None and math.isnan(out["b"]) and out["c"] == 1e300 and out["d"] == 0.0


def test_latest_reads_once_and_limits_before_the_shuffle(spark, tmp_path):
    spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), (None, None, "n"), (None, None, "m")], "k string, o int, v string").write.parquet(str(tmp_path / "t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = A.latest(spark.read.parquet(str(tmp_path / "t")), ["k"], "o")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]
        assert rows(df, "v") == [("m",), ("n",), ("y",), ("z",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
