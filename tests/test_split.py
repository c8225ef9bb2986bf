import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saldo.operators import split as P
from saldo.schemas import STREAMS, quarantine_schema, valid_schema
from saldo.sources.bronze import conform

NOW = "2024-06-01"


def rows_of(spark, kind, rows):
    cols = "event_id string, customer_id string, ref string, amount decimal(10,2), currency string, status string, code string"
    df = spark.createDataFrame(rows, cols)
    ref = {"refunds": "charge_id", "disputes": "charge_id", "subscriptions": "plan_id"}.get(kind, "charge_id")
    return conform(df.withColumnRenamed("ref", ref).withColumnRenamed("code", "failure_code"), STREAMS[kind])


CASES = [
    ("charges", (None, "x", 5, "USD"), "MISSING_CUSTOMER_ID"), ("charges", ("c", None, 5, "usd"), None),
    ("charges", ("c", "x", 5, "NULL"), "INVALID_CURRENCY"), ("charges", ("c", "x", 5, None), None),
    ("charges", ("c", "x", 0, "USD"), "INVALID_AMOUNT_NEGATIVE"), ("charges", ("c", "x", None, "USD"), None),
    ("charges", ("c", "x", 1000000, "USD"), None), ("charges", ("c", "x", Decimal("1000000.01"), "USD"), "INVALID_AMOUNT_TOO_LARGE"),
    ("refunds", ("c", None, -1, "XXX"), "MISSING_CHARGE_ID"), ("disputes", ("c", None, 1, "USD"), "MISSING_CHARGE_ID"),
    ("subscriptions", ("c", None, 1, "USD"), "MISSING_PLAN_ID"), ("subscriptions", ("c", "p", 0, "USD"), None),
    ("subscriptions", ("c", "p", -1, "USD"), "INVALID_AMOUNT_NEGATIVE"),
]


@pytest.mark.parametrize("kind", list(STREAMS))
def test_reasons(spark, kind):
    mine = [(v, want) for k, v, want in CASES if k == kind]
    data = [(str(i), c, r, None if a is None else Decimal(a), cur, "ok", None) for i, ((c, r, a, cur), _) in enumerate(mine)]
    got = rows_of(spark, kind, data).select("event_id", P.rejection_reason(kind).alias("r")).collect()
    assert {int(r["event_id"]): r["r"] for r in got} == {i: want for i, (_, want) in enumerate(mine)}


row = st.tuples(
    st.sampled_from([None, "c"]), st.sampled_from([None, "x"]), st.sampled_from([None, "-1", "0", "1", "1000000", "1000000.01"]),
    st.sampled_from([None, "usd", "EUR", "NULL", "", "xx"]), st.sampled_from([None, "failed", "succeeded"]), st.sampled_from([None, "z"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30), st.sampled_from(list(STREAMS)))
def test_split_is_a_partition_of_the_input(spark, rows, kind):
    data = [(str(i), c, r, None if a is None else Decimal(a), cur, s, code) for i, (c, r, a, cur, s, code) in enumerate(rows)]
    df = rows_of(spark, kind, data)
    ok, bad = P.split(df, kind, F.lit(NOW).cast("timestamp"))
    assert ok.schema.names == valid_schema(kind).names and bad.schema.names == quarantine_schema(kind).names
    left, right = [r["event_id"] for r in ok.collect()], [r["event_id"] for r in bad.collect()]
    assert sorted(left + right) == sorted(d[0] for d in data)
    assert ok.filter("validation_flag IS NULL").count() == 0
    assert bad.filter("rejection_reason IS NULL OR rejection_reason = 'UNKNOWN_VALIDATION_FAILURE'").count() == 0


def test_flags(spark):
    df = rows_of(spark, "charges", [("a", "c", "x", Decimal(5), "usd", "failed", None), ("b", "c", "x", Decimal(5), "usd", "failed", "z")])
    ok, _ = P.split_charges(df, F.lit(dt.datetime(2024, 1, 1)))
    assert {r["event_id"]: (r["validation_flag"], r["currency"]) for r in ok.collect()} == {"a": (True, "USD"), "b": (False, "USD")}
