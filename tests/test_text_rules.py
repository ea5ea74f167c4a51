"""Texts that a cast would take but a tick must not hold."""

import datetime as dt

import pytest

from ticklake.operators.ingest import coerce_numeric, filter_subscribed, parse_time
from ticklake.session import checkpoint_root


def test_numbers_with_a_suffix_or_in_hexadecimal_are_null(spark):
    texts = ["1.5", "1.5d", "2F", "0x1p3", "1e3", " 7 ", "Infinity", "x", None]
    rows = coerce_numeric(spark.createDataFrame([(t,) for t in texts], "price string"), ["price"]).collect()
    assert [r.price for r in rows] == [1.5, None, None, None, 1000.0, 7.0, float("inf"), None, None]


def test_a_time_without_a_date_is_null(spark):
    df = spark.createDataFrame([("12:30",), ("T12:30:00",), ("2024-01-15T12:30:00Z",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_time(df.t).cast("timestamp_ntz")).collect()]
    assert got[0] is None and got[1] is None and got[3] is None
    assert isinstance(got[2], dt.datetime) and got[2].day == 15


def test_subscriptions_with_repeats_keep_each_tick_once(spark):
    ticks = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "product_id string, n int")
    subs = spark.createDataFrame([("A",), ("A",), (None,)], "product_id string")
    assert sorted(r.n for r in filter_subscribed(ticks, subs).collect()) == [1, 3]


def test_no_private_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError):
        checkpoint_root(Session())
