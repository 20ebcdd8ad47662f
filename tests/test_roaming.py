import datetime as dt

from pyspark.sql import functions as F

from roamkit.config import AlertConfig, ValuedConfig
from roamkit.operators import roaming as M
from row_helpers import rows

D = dt.date


def test_name_from_email(spark):
    df = spark.createDataFrame([("jane.doe@x.com",), ("janedoe@x.com",), (None,), ("JOHN.o'neil@x",)], "e string")
    got = dict((r["e"], r["n"]) for r in df.select("e", M.name_from_email("e").alias("n")).collect())
    assert got == {"jane.doe@x.com": "Jane Doe", "janedoe@x.com": "", None: "", "JOHN.o'neil@x": "John O'neil"}


def test_traffic_type_variants(spark):
    schema = ("my_pmn_tadig_code string, their_pmn_tadig_code string, their_country_name string, "
              "serving_country_name string, subscriber_type string, b_traffic_type string, c_traffic_type string, "
              "b_country string")
    data = [
        ("AAA01", "BBB01", "x", "x", "prepaid", "m2m", "isr", "x"),   # M2M wins over ISR
        ("AAA01", "BBB01", "x", "x", "prepaid", None, "Isr", "x"),    # ISR
        ("NLD01", "NLD02", "nl", "nl", "prepaid", "other", None, "NL"),  # NR inbound; NR outbound (country)
        ("NLD01", "NLD02", "nl", "de", "NLM2M", "other", None, "de"),  # OTHER / OTH
        ("AAA01", "BBB01", "x", "y", "nlisr", None, None, "x"),       # IOT / ISR by subscriber type
    ]
    df = spark.createDataFrame(data, schema)
    got = [(r["i"], r["o"]) for r in df.select(M.traffic_type("inbound").alias("i"),
                                               M.traffic_type("outbound").alias("o")).collect()]
    assert got == [("M2M", "M2M"), ("ISR", "ISR"), ("NR", "NR"), ("OTHER", "OTH"), ("IOT", "ISR")]


def test_subscriber_class_and_split_code(spark):
    df = spark.createDataFrame([("NLDLT", "NLM2M"), ("NLDLT", "xIOTy"), ("NLDLT", "postpaid"), ("NLDLT", "pre"),
                                ("NLDLT", None), ("AAZVF", "pre"), ("OTHER", "pre")],
                               "my_pmn_tadig_code string, subscriber_type string")
    out = df.withColumn("subscriber_type", M.subscriber_class()).withColumn("code", M.split_code())
    assert [(r["subscriber_type"], r["code"]) for r in out.collect()] == [
        ("M2M", "NLM2M"), ("IOT", "NLIOT"), ("IOT", "NLIOT"), ("ISR", "NLISR"), ("ISR", "NLISR"),
        ("M2M", "AAZVF"), ("IOT", "OTHER")]


def test_recent_flag_edges(spark):
    top = D(2024, 3, 1)
    offsets = [0, 27, 28, 365, 366, 392, 393, 394]
    df = spark.createDataFrame([(top - dt.timedelta(days=o), top) for o in offsets], "d date, m date")
    got = {}
    for r in df.select("d", M.recent_flag("d", "m", 28, (393, 366)).alias("i"),
                       M.recent_flag("d", "m", 28, (392, 365)).alias("o")).collect():
        got[(top - r["d"]).days] = (r["i"], r["o"])
    assert got == {0: ("Y", "Y"), 27: ("Y", "Y"), 28: ("N", "N"), 365: ("N", "Y"), 366: ("Y", "Y"),
                   392: ("Y", "Y"), 393: ("Y", "N"), 394: ("N", "N")}


def test_rate_lookup_fallback_rules(spark):
    usage = spark.createDataFrame([
        (1, "D", "S", "GPRS", D(2020, 6, 15), 202006, False),  # exact month present
        (2, "D", "S", "GPRS", D(2020, 5, 15), 202005, False),  # exact missing, latest 202006 is later -> fallback
        (3, "D", "S", "GPRS", D(2020, 10, 15), 202010, False),  # latest 202006 is 4 months older -> NULL
        (4, "D", "S", "GPRS", D(2020, 9, 15), 202009, False),  # latest 202006 exactly 3 months older -> fallback
        (5, "D", "S", "MOC", D(2020, 3, 15), 202003, False),  # exact row with NULL rate -> fallback
        (6, "D", "S", "GPRS", D(2020, 6, 15), 202006, True),  # ISR -> NULL
    ], "id int, their_pmn_tadig_code string, my_pmn_tadig_code string, call_type string, call_date date, "
       "call_month bigint, isr boolean")
    rates = spark.createDataFrame([
        ("D", "S", "202006", "GPRS", 2.0), ("D", "S", "202004", "GPRS", 1.0),
        ("D", "S", "202003", "MOC", None), ("D", "S", "202002", "MOC", 5.0), ("D", "S", "202004", "MOC", 7.0),
    ], "dst_tadig string, src_tadig string, call_year_month string, call_type string, rate double")
    out = M.rate_lookup(usage, rates, "rate", F.col("isr"))
    got = {r["id"]: (r["iot_rate"], r["iot_call_year_month"]) for r in out.collect()}
    assert got == {1: (2.0, "202006"), 2: (2.0, "202006"), 3: (None, None), 4: (2.0, "202006"),
                   5: (7.0, "202004"), 6: (None, None)}


def test_value_usage_by_call_type(spark):
    types = ["MOC", "GPRS", "SMS-MT", "SMS-MO", "MTC", "SS", "XYZ"]
    df = spark.createDataFrame([(t, 10.0, 20.0, 3, 2.0) for t in types],
                               "call_type string, real_duration_minutes double, total_real_volume_mb double, "
                               "number_of_calls bigint, iot_rate double")
    inbound = [r["v"] for r in df.select(M.value_usage("inbound").alias("v")).collect()]
    outbound = [r["v"] for r in df.select(M.value_usage("outbound").alias("v")).collect()]
    assert inbound == [20.0, 40.0, 0.0, 6.0, 20.0, None, None]
    assert outbound == [20.0, 40.0, 0.0, None, 20.0, None, None]


def test_to_currency_volume_rules_and_gap(spark):
    usage = spark.createDataFrame([(D(2024, 1, 5), 100.0, 10.0), (D(2024, 1, 6), 100.0, None),
                                   (D(2024, 1, 7), 100.0, 0.0), (D(2024, 2, 5), 100.0, 10.0)],
                                  "call_date date, total_charges_sdr double, total_charged_volume_mb double")
    fx = spark.createDataFrame([("EUR", D(2024, 1, 1), D(2024, 1, 31), 1.5), ("USD", D(2024, 1, 1), D(2024, 1, 31), 9.0)],
                               "currency_code string, effective_date date, end_date date, "
                               "sdr_to_local_currency_exchange_rate double")
    got = rows(M.to_currency(usage, fx), "call_date", "total_charges_eur", "iot_rate_eur")
    assert got == [(D(2024, 1, 5), 150.0, 15.0), (D(2024, 1, 6), 150.0, 0.0), (D(2024, 1, 7), 150.0, None),
                   (D(2024, 2, 5), None, None)]


def test_price_change_zero_and_missing_previous(spark):
    df = spark.createDataFrame([
        ("A", "B", "GPRS", D(2024, 1, 10), 0.0, 5.0, 10.0),
        ("A", "B", "GPRS", D(2024, 2, 10), 2.0, 5.0, 10.0),
        ("A", "B", "GPRS", D(2024, 3, 10), 3.0, 5.0, 10.0),
        ("A", "B", "GPRS", D(2024, 3, 11), 3.0, 5.0, 10.0),
    ], "my_pmn_tadig_code string, their_pmn_tadig_code string, call_type string, call_date date, "
       "iot_rate_eur double, total_charges_eur double, total_charged_volume_mb double")
    got = {r["call_date"]: (r["percentage"], r["impact"]) for r in M.price_change(df).collect()}
    assert got[D(2024, 2, 10)] == (0.0, 20.0)
    assert got[D(2024, 3, 10)] == (50.0, 10.0)
    assert got[D(2024, 3, 11)] == (None, None)
    assert got[D(2024, 1, 10)] == (None, None)


def test_alert_base_filters(spark):
    cfg = AlertConfig(excluded_home=("H",), excluded_partner=("P",), excluded_pairs=("AB",), scan_days=10)
    df = spark.createDataFrame([
        (D(2024, 1, 30), "A", "C", "GPRS", 1.0, 2.0), (D(2024, 1, 30), "A", "C", "GPRS", 1.0, 2.0),
        (D(2024, 1, 30), "H", "C", "GPRS", 1.0, 2.0), (D(2024, 1, 30), "A", "P", "GPRS", 1.0, 2.0),
        (D(2024, 1, 30), "A", "B", "GPRS", 1.0, 2.0), (D(2024, 1, 30), None, "C", "GPRS", 1.0, 2.0),
        (D(2024, 1, 30), "A", "C", "MOC", 1.0, 2.0), (D(2024, 1, 10), "A", "C", "GPRS", 1.0, 2.0),
    ], "call_date date, my_pmn_tadig_code string, their_pmn_tadig_code string, call_type string, "
       "total_charged_volume_mb double, total_charges_sdr double")
    assert rows(M.alert_base(df, cfg, D(2024, 2, 1))) == [(D(2024, 1, 30), "A", "C", "GPRS", 2.0, 4.0)]


def test_steering_setting(spark):
    df = spark.createDataFrame([
        ("202001", "X", "NLISR", "GPRS", "d1", 0.0), ("202001", "X", "NLISR", "GPRS", "d2", 0.5),
        ("202001", "X", "NLISR", "GPRS", "d3", 0.2), ("202001", "X", "NLISR", "GPRS", "d4", None),
        ("202001", "Y", "S", "GPRS", "d5", -0.1), ("201912", "X", "S", "GPRS", "old", 0.9),
    ], "call_year_month string, target_country_name string, source_tadig string, call_type string, "
       "destination_tadig string, target_capture_rate double")
    got = rows(M.steering_setting(df), "source_tadig", "destination_tadig", "steering_settings")
    assert got == [("NLDLT", "d1", "B"), ("NLDLT", "d2", "P"), ("NLDLT", "d3", "NP"), ("NLDLT", "d4", None),
                   ("S", "d5", None)]


def test_latest_names_single_scan_equals_double_rank(spark):
    schema = ("call_date date, my_pmn_tadig_code string, my_operator_name string, my_country_name string, "
              "their_pmn_tadig_code string, their_operator_name string, their_primary_operator_name string, "
              "their_country_name string")
    inb = spark.createDataFrame([
        (D(2024, 1, 2), "A", "opA", "cA", "B", "", "primB", "cB"),
        (D(2024, 1, 2), "A", "opA2", "cA", "B", "opB", "primB", "cB"),
        (D(2024, 1, 1), "C", "opC", "cC", None, None, None, None),
    ], schema)
    out = spark.createDataFrame([(D(2024, 1, 3), "B", "opB3", "cB3", "A", "x", "y", None)], schema)
    got = rows(M.latest_names(inb, out), "tadig", "syn_operator", "syn_country", "call_date")
    assert got == [("A", "x", None, D(2024, 1, 3)), ("B", "opB3", "cB3", D(2024, 1, 3)),
                   ("C", "opC", "cC", D(2024, 1, 1)), (None, None, None, D(2024, 1, 1))]


def test_rate_table_gives_the_same_as_two_lookups(spark):
    """Duplicate months, gaps, NULL keys and rates: the (key, month) table and the two equi-joins agree; no array is folded."""
    import random
    rng = random.Random(4)
    pick = lambda xs: rng.choice(xs)
    months = [201911, 201912, 202001, 202002, 202003, 202004, 202005, 202006, 202007, 202008]
    rates = spark.createDataFrame([(pick(["D", "E", None]), "S", str(pick(months[:7])), pick(["GPRS", "MOC"]), pick([None, 1.0, 2.0, 3.0])) for _ in range(40)],
                                  "dst_tadig string, src_tadig string, call_year_month string, call_type string, rate double")
    usage = spark.createDataFrame([(k, pick(["D", "E", "F", None]), "S", pick(["GPRS", "MOC", "SS"]), D(m // 100, m % 100, 28), m, pick([True, False, False]))
                                   for k, m in enumerate(months * 20)],
                                  "id int, their_pmn_tadig_code string, my_pmn_tadig_code string, call_type string, call_date date, call_month bigint, isr boolean")
    staged = []

    def stage(df, name):
        staged.append(name)
        return df

    table = M.rate_lookup(usage, rates, "rate", F.col("isr"), months=(201911, 202008), stage=stage)
    plain = M.rate_lookup(usage, rates, "rate", F.col("isr"))
    assert rows(table, "id", "iot_rate", "iot_call_year_month") == rows(plain, "id", "iot_rate", "iot_call_year_month")
    assert staged == ["asof_rates"]
    assert "collect_list" not in table._jdf.queryExecution().executedPlan().toString()


def test_capitals_once_a_name(spark):
    from roamkit.functions import scalars as S
    from roamkit.operators import joins as J
    df = spark.createDataFrame([("bosnia-herzegovina", None), ("isle of man", "bosnia-herzegovina"), (None, "")], "a string, b string")
    names = J.value_map(df, ["a", "b"], S.initcap)
    assert names.count() == 3
    got = J.with_mapped(df, names, {"x": "a", "y": "b"})
    assert rows(got, "x", "y") == rows(df.select(S.initcap("a").alias("x"), S.initcap("b").alias("y")))


def test_deviation_floor_needs_no_job_while_planning(spark, tmp_path):
    """The month floor is a subquery whose value reaches the scan."""
    days = [D(2020, m, 15) for m in range(1, 13)]
    spark.createDataFrame([(x,) for x in days], "call_date date").write.parquet(str(tmp_path / "u"))
    df = spark.read.parquet(str(tmp_path / "u"))
    out = df.where(F.col("call_date") >= M.month_floor(df).scalar())
    assert sorted(r["call_date"].month for r in out.collect()) == [10, 11, 12]
    assert "Subquery" in out._jdf.queryExecution().executedPlan().toString()
