"""Edge rows of the cleaning rules (FIXTURES.md section 2), table driven."""

import datetime as dt
import json

import pytest

from tradelake.functions.json import decode_json
from tradelake.operators import message_fields, split_trades

UTC = dt.timezone.utc
BASE = {"symbol": "btcusdt", "price": "42000.5", "quantity": "0.01", "timestamp": 1704067200000}
T0 = dt.datetime(2024, 1, 1, tzinfo=UTC)


def with_(**kw):
    d = dict(BASE)
    for k, v in kw.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


# (message text, expected clean row or reject reason)
CASES = [
    (with_(), ("BTCUSDT", 42000.5, 0.01, T0)),
    (with_(symbol=KeyError), ("UNKNOWN", 42000.5, 0.01, T0)),
    (with_(symbol=None), ("UNKNOWN", 42000.5, 0.01, T0)),
    (with_(symbol=""), ("", 42000.5, 0.01, T0)),
    (with_(symbol=123), ("123", 42000.5, 0.01, T0)),
    (with_(price=KeyError), "missing_price"),
    (with_(price=None), "invalid_price"),
    (with_(price="abc"), "invalid_price"),
    (with_(price=[1]), "invalid_price"),
    (with_(price=0), "invalid_price"),
    (with_(price=-1), "invalid_price"),
    (with_(price="1.5d"), "invalid_price"),
    (with_(price="1_000"), ("BTCUSDT", 1000.0, 0.01, T0)),
    (with_(price="nan"), "invalid_price"),
    (with_(price="Infinity"), ("BTCUSDT", float("inf"), 0.01, T0)),
    (with_(quantity=True), ("BTCUSDT", 42000.5, 1.0, T0)),
    (with_(quantity=False), "invalid_quantity"),
    (with_(timestamp=KeyError), "missing_timestamp"),
    (with_(timestamp=None), "invalid_timestamp"),
    (with_(timestamp=1704067200), ("BTCUSDT", 42000.5, 0.01, T0)),
    (with_(timestamp=1704067200.5), ("BTCUSDT", 42000.5, 0.01, T0 + dt.timedelta(milliseconds=500))),
    (with_(timestamp=99999999999), ("BTCUSDT", 42000.5, 0.01, dt.datetime(5138, 11, 16, 9, 46, 39, tzinfo=UTC))),
    (with_(timestamp=100000000000), ("BTCUSDT", 42000.5, 0.01, dt.datetime(1973, 3, 3, 9, 46, 40, tzinfo=UTC))),
    (with_(timestamp=0), ("BTCUSDT", 42000.5, 0.01, dt.datetime(1970, 1, 1, tzinfo=UTC))),
    (with_(timestamp=-1), ("BTCUSDT", 42000.5, 0.01, dt.datetime(1969, 12, 31, 23, 59, 59, tzinfo=UTC))),
    (with_(timestamp=True), ("BTCUSDT", 42000.5, 0.01, dt.datetime(1970, 1, 1, 0, 0, 1, tzinfo=UTC))),
    (with_(timestamp="2024-01-01"), ("BTCUSDT", 42000.5, 0.01, T0)),
    (with_(timestamp="2024-01-01T00:00:00+05:30"), ("BTCUSDT", 42000.5, 0.01, dt.datetime(2023, 12, 31, 18, 30, tzinfo=UTC))),
    (with_(timestamp="20240101"), ("BTCUSDT", 42000.5, 0.01, T0)),
    (with_(timestamp="20240101T010203"), ("BTCUSDT", 42000.5, 0.01, dt.datetime(2024, 1, 1, 1, 2, 3, tzinfo=UTC))),
    (with_(timestamp="2024-01-01 10:00:00.1234567Z"), ("BTCUSDT", 42000.5, 0.01, dt.datetime(2024, 1, 1, 10, 0, 0, 123000, tzinfo=UTC))),
    (with_(timestamp="2024"), "invalid_timestamp"),
    (with_(timestamp="2024-1-1"), "invalid_timestamp"),
    (with_(timestamp="12:00"), "invalid_timestamp"),
    (with_(timestamp="2024-02-30"), "invalid_timestamp"),
    (with_(timestamp="1704067200000"), "invalid_timestamp"),
    (with_(timestamp=1704067200000000), "timestamp_out_of_range"),
    (with_(timestamp=1e300), "timestamp_out_of_range"),
    ("[1]", "not_an_object"),
    ('"x"', "not_an_object"),
    ("7", "not_an_object"),
    ("notjson", "malformed_json"),
]


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id bigint, value string")
    sp = split_trades(message_fields(decode_json(df)), keep=("id",))
    clean = {r.id: (r.symbol, r.price, r.quantity, r.timestamp) for r in sp.clean.collect()}
    rejects = {r.id: r.reject_reason for r in sp.rejects.collect()}
    return clean, rejects


@pytest.mark.parametrize("i", range(len(CASES)))
def test_edge_row(results, i):
    clean, rejects = results
    text, expected = CASES[i]
    assert (i in clean) != (i in rejects), text
    if isinstance(expected, str):
        assert rejects.get(i) == expected, (text, clean.get(i))
    else:
        got = clean.get(i)
        assert got is not None, (text, rejects.get(i))
        sym, price, qty, ts = got
        assert (sym, price, qty) == expected[:3], text
        assert ts.replace(tzinfo=UTC) == expected[3], text


def test_minute_bucket_floor(spark):
    from pyspark.sql import functions as F

    from tradelake.functions import minute_bucket

    rows = spark.createDataFrame([(60000,), (59999,), (-1,), (0,), (-60000,), (-60001,)], "ms bigint")
    got = [r.m for r in rows.select(minute_bucket(F.col("ms")).alias("m")).collect()]
    assert got == [1, 0, -1, 0, -1, -2]


def test_raw_exchange_messages(spark):
    from tradelake.operators import from_exchange

    rows = [
        (1, '{"s": "btcusdt", "p": "42000.5", "q": "0.01", "T": 1704067200000, "e": "trade"}'),
        (2, '{"p": "1", "q": "1", "T": 1704067200000}'),
        (3, '{"s": "x", "p": "bad", "q": "1", "T": 1704067200000}'),
    ]
    df = decode_json(spark.createDataFrame(rows, "id bigint, value string"))
    sp = split_trades(from_exchange(df), keep=("id",))
    assert [(r.id, r.symbol, r.price) for r in sp.clean.collect()] == [(1, "BTCUSDT", 42000.5)]
    assert sorted((r.id, r.reject_reason) for r in sp.rejects.collect()) == [(2, "missing_symbol"), (3, "invalid_price")]


def test_typed_input(spark):
    """Already typed columns take the typed branches (no VARIANT)."""
    rows = [("a", 1.0, 2.0, 1704067200000), ("b", float("nan"), 1.0, 1704067200000), ("c", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "symbol string, price double, quantity double, timestamp bigint")
    sp = split_trades(df)
    assert [(r.symbol, r.timestamp.year) for r in sp.clean.collect()] == [("A", 2024)]
    assert sorted(r.reject_reason for r in sp.rejects.collect()) == ["invalid_price", "invalid_timestamp"]


def test_no_filter_node_in_clean_plan(spark):
    """The rules run once per row: no Filter re-evaluating them below the projections."""
    df = spark.createDataFrame([(with_(),)], "value string")
    plan = split_trades(message_fields(decode_json(df))).clean._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan
