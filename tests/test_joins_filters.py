import datetime as dt
import random

from pyspark.sql import functions as F

from roamkit.operators import filters as P
from roamkit.operators import joins as J
from row_helpers import rows

D = dt.date


def test_not_in_list_drops_null_and_neq_variants(spark):
    df = spark.createDataFrame([("Bilateral",), ("Inbound",), (None,)], "d string")
    assert rows(P.filter_not_in(df, "d", ["Inbound"])) == [("Bilateral",)]
    assert rows(P.filter_neq(df, "d", "Bilateral")) == [("Inbound",)]
    assert rows(P.filter_neq(df, "d", "Bilateral", keep_null=True)) == [("Inbound",), (None,)]


def test_exclude_pairs_drops_null_codes(spark):
    df = spark.createDataFrame([("NZLBS", "NZLNH"), ("NZLBS", "X"), (None, "X")], "a string, b string")
    assert rows(P.exclude_pairs(df, "a", "b", ["NZLBSNZLNH"])) == [("NZLBS", "X")]


def test_month_bound_text_and_number(spark):
    df = spark.createDataFrame([("202003",), ("202004",), (None,)], "m string")
    assert rows(P.month_bound(df, "m", "<", "202004")) == [("202003",)]
    assert rows(P.month_bound(df, "m", ">", 202003)) == [("202004",)]


def test_is_true_filter(spark):
    df = spark.createDataFrame([("a", True), ("b", None), ("c", False)], "k string, b boolean")
    assert rows(P.filter_is_true(df, "b"), "k") == [("a",)]


def test_not_in_null_aware(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    empty = spark.createDataFrame([], "v string")
    plain = spark.createDataFrame([("1",)], "v string")
    with_null = spark.createDataFrame([("1",), (None,)], "v string")
    assert rows(J.not_in(df, "k", empty, "v")) == [("1",), ("2",), (None,)]
    assert rows(J.not_in(df, "k", plain, "v")) == [("2",)]
    assert rows(J.not_in(df, "k", with_null, "v")) == []


def test_not_exists_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", None)], "k string, d date")
    prev = spark.createDataFrame([("a", D(2024, 1, 1)), ("a", None)], "k string, d date")
    assert rows(J.not_exists(df, prev, {"k": "k", "d": "d"})) == [("a", None)]
    assert rows(J.not_exists(df, prev, {"k": "k", "d": "d"}, null_safe=True)) == []


def test_lookup_right_predicate_keeps_unmatched(spark):
    fact = spark.createDataFrame([("x",), ("y",)], "k string")
    dim = spark.createDataFrame([("x", 1, "one"), ("y", 2, "two")], "k string, rnk int, v string")
    out = J.lookup(fact, dim, {"k": "k"}, {"v": "v"}, right_pred=F.col("rnk") == 1)
    assert rows(out) == [("x", "one"), ("y", None)]


def test_lookup_expr_trims_both_keys(spark):
    fact = spark.createDataFrame([(" ASIA",), ("EUROPE",)], "k string")
    dim = spark.createDataFrame([("ASIA ", "apac"), ("EUROPE", "emea")], "t string, r string")
    assert rows(J.lookup_expr(fact, dim, "k", "t", {"r": "r"}, F.trim)) == [(" ASIA", "apac"), ("EUROPE", "emea")]


def test_range_join_matches_brute_force(spark):
    rnd = random.Random(7)
    base = D(2023, 1, 1)
    facts = [(i, base + dt.timedelta(days=rnd.randrange(0, 400))) for i in range(300)] + [(999, None)]
    wins = []
    for w in range(25):
        s = base + dt.timedelta(days=rnd.randrange(0, 400))
        wins.append((w, s, s + dt.timedelta(days=rnd.randrange(-5, 90))))
    wins.append((98, None, base))
    f = spark.createDataFrame(facts, "id int, d date")
    w = spark.createDataFrame(wins, "w int, s date, e date")
    got = rows(J.as_valid_join(f, w, "d", "s", "e", {"w": "w"}), "id", "w")
    want = []
    for i, d in facts:
        hits = [x for x, s, e in wins if d is not None and s is not None and e is not None and s <= d <= e]
        want += [(i, x) for x in hits] or [(i, None)]
    assert got == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    inner = rows(J.assign_period(f, w, "d", "s", "e", {"w": "w"}), "id", "w")
    assert inner == [t for t in got if t[1] is not None]


def test_period_over_period_month_end(spark):
    days = [D(2023, 1, d) for d in (27, 28, 29, 30, 31)] + [D(2023, 2, 28)] + [D(2023, 3, d) for d in (28, 29, 30, 31)]
    df = spark.createDataFrame([("p", d) for d in days], "k string, d date")
    out = J.period_over_period(df, ["k"], "d", {"d_30": "d"})
    got = {}
    for r in out.collect():
        got.setdefault(r["d"], set()).add(r["d_30"])
    assert got[D(2023, 2, 28)] == {D(2023, 1, 28), D(2023, 1, 29), D(2023, 1, 30), D(2023, 1, 31)}
    assert got[D(2023, 3, 28)] == {D(2023, 2, 28)}
    for d in (29, 30, 31):
        assert got[D(2023, 3, d)] == {None}


def test_bounded_broadcast_respects_limit(spark):
    small = spark.range(10)
    hinted = J.bounded_broadcast(small)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    unhinted = J.bounded_broadcast(small, limit=1)
    assert "broadcast" not in unhinted._jdf.queryExecution().analyzed().toString().lower()
    assert J.estimated_bytes(small.crossJoin(small).crossJoin(small)) > 0


def test_with_scalar_attaches_one_row(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    top = df.agg(F.max("x").alias("m"))
    assert rows(J.with_scalar(df, top)) == [(1, 2), (2, 2)]


def test_range_join_open_ended_window_is_clipped(spark):
    facts = spark.createDataFrame([(1, D(2024, 3, 5)), (2, D(2020, 1, 1)), (3, None)], "id int, d date")
    wins = spark.createDataFrame([("open", D(2021, 1, 1), D(9999, 12, 31)), ("old", D(2019, 12, 1), D(2020, 1, 31))],
                                 "w string, s date, e date")
    assert rows(J.as_valid_join(facts, wins, "d", "s", "e", {"w": "w"}), "id", "w") == [
        (1, "open"), (2, "old"), (3, None)]
    empty = facts.where("false")
    assert J.as_valid_join(empty, wins, "d", "s", "e", {"w": "w"}).count() == 0


def test_range_join_index_is_bounded(spark):
    """A 10-year, a one-day and an endless window in one table: few listed rows, the facts in the plan once."""
    from pyspark.sql import functions as F
    wins = spark.createDataFrame([(D(2010, 1, 1), D(2019, 12, 31), "long"), (D(2015, 5, 5), D(2015, 5, 5), "day"), (D(1, 1, 1), D(9999, 12, 31), "ever")]
                                 + [(D(2012, 1, 1) + dt.timedelta(k), D(2012, 1, 1) + dt.timedelta(k), f"d{k}") for k in range(300)], "s date, e date, w string")
    w = wins.select(F.unix_date("s").alias("__s"), F.unix_date("e").alias("__e"))
    shape = J._window_shape(w).collect()
    assert len(shape) == 1
    listed = J.with_scalar(w, J._window_shape(w)).select(F.explode(F.sequence(J._bucket("__s"), J._bucket("__e"))))
    assert listed.count() <= 4 * wins.count()
    facts = spark.createDataFrame([(k, D(2009, 12, 25) + dt.timedelta(13 * k)) for k in range(290)] + [(999, None), (1000, D(2015, 5, 5)), (1001, D(9000, 1, 1)), (1002, D(2, 1, 1))], "id int, d date")
    got = rows(J.as_valid_join(facts, wins, "d", "s", "e", {"w": "w"}), "id", "w")
    plain = rows(facts.join(wins, (F.col("d") >= F.col("s")) & (F.col("d") <= F.col("e")), "left"), "id", "w")
    assert got == plain


def test_range_join_reads_facts_once(spark, tmp_path):
    spark.createDataFrame([(1, D(2020, 1, 5))], "id int, d date").write.parquet(str(tmp_path / "facts"))
    wins = spark.createDataFrame([(D(2020, 1, 1), D(2020, 1, 31), "w")], "s date, e date, w string")
    df = J.as_valid_join(spark.read.parquet(str(tmp_path / "facts")), wins, "d", "s", "e", {"w": "w"})
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
