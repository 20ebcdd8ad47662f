"""Property tests: NULL-sensitive operators against plain-Python statements of their rules."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from roamkit.operators import joins as J
from roamkit.operators import sets as U
from roamkit.sources import binding as B

CODES = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(left=st.lists(CODES, max_size=8), sub=st.lists(CODES, max_size=5))
def test_not_in_matches_sql_rule(spark, left, sub):
    df = spark.createDataFrame([(x,) for x in left], "k string")
    other = spark.createDataFrame([(x,) for x in sub], "v string")
    got = sorted((r["k"] for r in J.not_in(df, "k", other, "v").collect()), key=str)
    if not sub:
        want = left
    elif None in sub:
        want = []
    else:
        want = [x for x in left if x is not None and x not in sub]
    assert got == sorted(want, key=str)


MONTHS = st.one_of(st.none(), st.sampled_from(["201912", "202001", "202002", "202003"]))


@SETTINGS
@given(data=st.lists(st.tuples(MONTHS, CODES), max_size=10))
def test_cutover_matches_two_branch_rule(spark, data):
    df = spark.createDataFrame(data, "m string, c string")
    got = sorted(((r["m"], r["c"]) for r in U.cutover(df, "m", 202002, "c", ["a"], as_text=True).collect()), key=str)
    want = [(m, c) for m, c in data if m is not None and (m < "202002" or (m > "202001" and c is not None and c != "a"))]
    assert got == sorted(want, key=str)


@SETTINGS
@given(data=st.lists(st.tuples(CODES, st.sampled_from(["Bilateral", "Inbound", "Outbound", None])), max_size=8))
def test_split_direction_rule(spark, data):
    df = spark.createDataFrame(data, "n string, d string")
    got = sorted(((r["n"], r["d"]) for r in U.split_direction(df, "d").collect()), key=str)
    want = []
    for n, d in data:
        want += [(n, "Inbound"), (n, "Outbound")] if d == "Bilateral" else [(n, d)]
    assert got == sorted(want, key=str)


def test_binding_closure_orders_dependencies():
    order = B.closure(["load_audit", "rate_card"])
    assert order.index("landing") < order.index("load_audit")
    assert order.index("inbound_usage") < order.index("rate_card")
    ctes = B.duck_ctes(["rate_card"])
    assert ctes[0].startswith("inbound_usage as (") and ctes[-1].startswith("rate_card as (")
    assert "{" not in "".join(ctes)
