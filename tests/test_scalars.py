import datetime as dt

import pytest
from pyspark.sql import functions as F

from roamkit.functions import scalars as S
from row_helpers import rows


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("bosnia-herzegovina", "Bosnia-Herzegovina"),
    ("COTE D'IVOIRE", "Cote D'ivoire"),
    ("são tomé & príncipe", "São Tomé & Príncipe"),
    ("first.last", "First.Last"),
    ("a_b(c)d/e", "A_B(C)D/E"),
    ("", ""),
    ("united  KINGDOM of 1st o'brien", "United  Kingdom Of 1st O'brien"),
    (None, None),
])
def test_initcap_splits_on_punctuation(spark, text, expected):
    assert one(spark, S.initcap("s"), text) == expected


def test_substr_position_zero_and_negative(spark):
    assert one(spark, S.substr("s", 0, 3), "ABCDE") == "ABC"
    assert one(spark, S.substr("s", -4), "Tue Mar 01 00:00:00 GMT 2022") == "2022"
    assert one(spark, S.substr("s", 5, 6), "Tue Mar 01 00:00:00 GMT 2022") == "Mar 01"


@pytest.mark.parametrize("text,expected", [
    ("Tue Mar 01 00:00:00 GMT 2022", dt.date(2022, 3, 1)),
    ("Tue Mar  1 00:00:00 GMT 2022", dt.date(2022, 3, 1)),
    ("Wed Dec 31 00:00:00 GMT 2025", dt.date(2025, 12, 31)),
    (None, None),
])
def test_parse_crm_date(spark, text, expected):
    assert one(spark, S.parse_crm_date("s"), text) == expected


def test_parse_crm_date_strict_raises_and_lenient_nulls(spark):
    df = spark.createDataFrame([("",)], "s string")
    with pytest.raises(Exception):
        df.select(S.parse_crm_date("s")).collect()
    assert df.select(S.parse_crm_date("s", strict=False).alias("d")).first()["d"] is None


def test_safe_divide_and_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    assert rows(df.select(S.safe_divide("a", "b").alias("q")), "q") == [(2.0,), (None,), (None,)]
    assert rows(df.select(S.divide("a", "b").alias("q")), "q") == [(2.0,), (None,), (None,)]


def test_if_empty_keeps_null(spark):
    df = spark.createDataFrame([("", "p"), (None, "p"), ("x", "p")], "a string, b string")
    assert rows(df.select(S.if_empty("a", "b").alias("r")), "r") == [("p",), ("x",), (None,)]


def test_split_at_out_of_range_is_null(spark):
    df = spark.createDataFrame([("a.b@x",), ("ab@x",), (None,)], "e string")
    local = S.split_at("e", "@", 0)
    got = rows(df.select(S.split_at(local, ".", 0).alias("f"), S.split_at(local, ".", 1).alias("g")), "f", "g")
    assert got == [("a", "b"), ("ab", None), (None, None)]


def test_add_months_clamps(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 31),), (dt.date(2019, 2, 28),)], "d date")
    got = rows(df.select(S.add_months("d", 1).alias("m")), "m")
    assert got == [(dt.date(2019, 3, 28),), (dt.date(2023, 2, 28),)]


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 17),)], "d date")
    r = df.select(S.trunc_month("d").alias("t"), S.yyyymm(S.add_months("d", -3)).alias("m"),
                  S.date_sub("d", 6).alias("s"), S.date_text("d").alias("x")).first()
    assert (r["t"], r["m"], r["s"], r["x"]) == (dt.date(2020, 5, 1), 202002, dt.date(2020, 5, 11), "2020-05-17")


def test_map_status_every_value(spark):
    from roamkit.config import STATUS_GROUPS
    values = [k for k, _ in STATUS_GROUPS] + ["Frozen", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = dict((r["s"], r["g"]) for r in df.select("s", S.map_status("s").alias("g")).collect())
    assert got["Live"] == "Open" and got["CLL"] == "Progressing" and got["NA"] == "Not Open"
    assert got["Frozen"] == "Not Open" and got[None] == "Not Open"
    assert sum(1 for v in got.values() if v == "Progressing") == 7


def test_safe_cast_and_before_first(spark):
    df = spark.createDataFrame([("202003", "2024-01-01 10:00:00+00:00"), ("x", "no-plus")], "m string, e string")
    got = rows(df.select(S.safe_cast("m", "bigint").alias("n"), S.before_first("e", "+").alias("b")), "n", "b")
    assert got == [(202003, "2024-01-01 10:00:00"), (None, "no-plus")]


def test_is_true_null_safe(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert rows(df.select(S.is_true("b").alias("t")), "t") == [(False,), (False,), (True,)]


def test_exact_sum_is_order_independent(spark):
    vals = [(0.1,)] * 10 + [(1e10,), (-1e10,)]
    a = spark.createDataFrame(vals, "x double").agg(S.exact_sum("x").alias("s")).first()["s"]
    b = spark.createDataFrame(list(reversed(vals)), "x double").repartition(5).agg(S.exact_sum("x").alias("s")).first()["s"]
    assert a == b == 1.0
