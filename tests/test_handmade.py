"""Hand-made rows for the semantic traps (FIXTURES.md §6)."""

from datetime import datetime

import pytest

from ticklake import plans
from ticklake.operators import book
from ticklake.operators.ingest import good_ticks, ingest
from tests.ticks import make_ticks

DAY = "2024-01-15"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_zero_price_returns_dropped(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 10.0, "time": "2024-01-15 10:00:10"},
        {"product_id": "A", "price": 0.0, "time": "2024-01-15 10:01:10"},
        {"product_id": "A", "price": 5.0, "time": "2024-01-15 10:02:10"},
    ])
    assert plans.returns(t, "A", DAY).count() == 0
    assert plans.volatility(t, "A", DAY).count() == 0


def test_zero_volume_vwap_null(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 10.0, "last_size": 0.0, "time": "2024-01-15 10:00:10"},
        {"product_id": "A", "price": 11.0, "last_size": 0.0, "time": "2024-01-15 10:00:20"},
    ])
    assert plans.vwap(t, "A", "day", datetime(2024, 1, 15, 12)).count() == 0
    r = rows(plans.quickvwap(t, DAY))
    assert r == [{"product_id": "A", "cumulative_volume": 0.0, "vwap": None}]


def test_null_price_last_in_minute(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 10.0, "time": "2024-01-15 10:00:10"},
        {"product_id": "A", "price": None, "time": "2024-01-15 10:00:50"},
        {"product_id": "A", "price": 20.0, "time": "2024-01-15 10:01:10"},
    ])
    r = rows(plans.returns(t, "A", DAY))
    assert len(r) == 1 and r[0]["price"] == 20.0
    assert abs(r[0]["return"] - 0.6931471805599453) < 1e-12


def test_tie_on_time_higher_sequence_wins(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 1.0, "time": "2024-01-15 10:00:00", "sequence": 1},
        {"product_id": "A", "price": 2.0, "time": "2024-01-15 10:00:30", "sequence": 2},
        {"product_id": "A", "price": 3.0, "time": "2024-01-15 10:00:30", "sequence": 3},
        {"product_id": "A", "price": 6.0, "time": "2024-01-15 10:01:00", "sequence": 4},
    ])
    r = rows(plans.returns(t, "A", DAY))
    assert r[0]["price"] == 6.0 and abs(r[0]["return"] - 0.6931471805599453) < 1e-12
    top = rows(book.top_of_book(t.where("sequence <= 3")))
    assert top[0]["sequence"] == 3


def test_one_bucket_no_returns(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 10.0, "time": "2024-01-15 10:00:10"},
        {"product_id": "A", "price": 11.0, "time": "2024-01-15 10:00:20"},
    ])
    assert plans.returns(t, "A", DAY).count() == 0
    assert plans.volatility(t, "A", DAY).count() == 0


def test_constant_series(spark):
    data = [{"product_id": s, "price": 7.0, "time": f"2024-01-15 10:0{m}:10"}
            for s in ("A", "B") for m in range(5)]
    t = make_ticks(spark, data)
    v = rows(plans.volatility(t, "A", DAY))
    assert v == [{"product_id": "A", "volatility": 0.0}]
    assert plans.correlation(t, "A", "B", DAY).count() == 0


def test_correlation_same_symbol_is_one(spark):
    data = [{"product_id": "A", "price": p, "time": f"2024-01-15 10:0{m}:10"}
            for m, p in enumerate([1.0, 2.0, 1.5, 3.0, 2.5])]
    t = make_ticks(spark, data)
    r = rows(plans.correlation(t, "A", "A", DAY))
    assert abs(r[0]["correlation"] - 1.0) < 1e-12


def test_window_over_midnight(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 10.0, "time": "2024-01-14 23:59:00"},
        {"product_id": "A", "price": 12.0, "time": "2024-01-15 00:01:00"},
    ])
    r = rows(plans.high_low(t, "A", "5m", datetime(2024, 1, 15, 0, 3)))
    assert r == [{"product_id": "A", "timeframe": "5m", "low": 12.0, "high": 12.0}]


def test_equal_sequences(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 1.0, "time": "2024-01-15 10:00:00", "sequence": 5, "trade_id": 1,
         "side": "buy", "recieved": datetime(2024, 1, 15, 10)},
        {"product_id": "A", "price": 1.0, "time": "2024-01-15 10:00:01", "sequence": 5, "trade_id": 2,
         "side": "buy", "recieved": datetime(2024, 1, 15, 10)},
        {"product_id": "A", "price": 1.0, "time": "2024-01-15 10:00:02", "sequence": 8, "trade_id": 3,
         "side": "buy", "recieved": datetime(2024, 1, 15, 10)},
    ])
    t = t.fillna(1.0)
    got = [r["ordering"] for r in plans.sequence_gaps(t, DAY).orderBy("trade_id").collect()]
    assert got == [None, 0.001, 3.0]


def test_symbol_validation():
    with pytest.raises(ValueError):
        plans.high_low(None, "A;B")
    with pytest.raises(ValueError):
        plans.correlation(None, "A", "B C")


def test_unknown_timeframe_is_since_midnight(spark):
    t = make_ticks(spark, [
        {"product_id": "A", "price": 10.0, "time": "2024-01-15 01:00:00"},
        {"product_id": "A", "price": 14.0, "time": "2024-01-15 11:00:00"},
    ])
    r = rows(plans.high_low(t, "A", "2w", datetime(2024, 1, 15, 12)))
    assert r == [{"product_id": "A", "timeframe": "2w", "low": 10.0, "high": 14.0}]


def test_extra_and_missing_fields(spark):
    raw = spark.createDataFrame([(
        "A", '{"type":"ticker","sequence":1,"product_id":"A","price":"1.5","foo":"bar",'
             '"time":"2024-01-15T10:00:00.000001Z","trade_id":7,"Recieved":"15-01-2024 10:00:01.000000"}')],
        "key string, value string")
    good = good_ticks(ingest(raw))
    assert "foo" not in good.columns
    r = rows(good)[0]
    assert r["side"] is None and r["price"] == 1.5 and r["sequence"] == 1
    assert r["time"] == datetime(2024, 1, 15, 10, 0, 0, 1)
    assert (r["year"], r["month"], r["day"]) == (2024, 1, 15)


def test_latest_prices_limit_and_order(spark):
    data = [{"product_id": "A", "price": float(i), "time": f"2024-01-15 10:{i:02d}:00",
             "recieved": datetime(2024, 1, 15, 10, i)} for i in range(20)]
    t = make_ticks(spark, data)
    r = rows(plans.latest_prices(t, "A", 3, datetime(2024, 1, 15, 12)))
    assert sorted(x["price"] for x in r) == [17.0, 18.0, 19.0]


def test_non_object_json_is_bad_json(spark):
    from ticklake.operators.ingest import dead_letters

    raw = spark.createDataFrame([("A", "[1,2]"), ("A", "42"), ("A", None), ("A", '{"type":"ticker"')],
                                "key string, value string")
    reasons = sorted(r["reason"] for r in dead_letters(ingest(raw)).collect())
    assert reasons == ["bad_json"] * 4


def test_dense_minutes_on_stored_time_type(spark):
    base = {"product_id": "A", "side": "buy", "recieved": datetime(2024, 1, 15, 10)}
    t = make_ticks(spark, [
        {**base, "price": 1.0, "time": "2024-01-15 10:00:10", "sequence": 1, "trade_id": 1},
        {**base, "price": 2.0, "time": "2024-01-15 10:00:40", "sequence": 2, "trade_id": 2},
        {**base, "price": 4.0, "time": "2024-01-15 10:03:05", "sequence": 5, "trade_id": 3},
    ]).fillna(1.0)
    dense = plans.resample_mean(t, DAY, dense=True).orderBy("bucket").collect()
    assert [r["bucket"].minute for r in dense] == [0, 1, 2, 3]
    assert [r["price"] for r in dense] == [1.5, None, None, 4.0]
    sparse = plans.resample_mean(t, DAY).collect()
    assert len(sparse) == 2
    gaps = plans.gap_series(t, DAY).orderBy("bucket").collect()
    assert [r["ordering"] for r in gaps] == [1.0, None, None, 3.0]


def test_volatility_level_thresholds(spark):
    # minute means of last_size 10, 10, 10, 10, 20: sigma = sqrt(20) = 4.47; the last delta
    # (10) lies in (2 sigma, 3 sigma] -> VERY_HIGH; the first minute has no delta -> NORMAL
    base = {"product_id": "A", "side": "buy", "recieved": datetime(2024, 1, 15, 10)}
    sizes = [10.0, 10.0, 10.0, 10.0, 20.0]
    t = make_ticks(spark, [{**base, "price": 1.0, "last_size": s, "time": f"2024-01-15 10:0{m}:30",
                            "sequence": m + 1, "trade_id": m + 1} for m, s in enumerate(sizes)]).fillna(1.0)
    lv = [(r["level"], r["volatility_level"]) for r in plans.volatility_levels(t, DAY).orderBy("bucket").collect()]
    assert lv == [(1, "NORMAL")] * 4 + [(3, "VERY_HIGH")]
    ev = plans.volatility_events(t, DAY).collect()
    assert len(ev) == 1 and ev[0]["volatility_level"] == "VERY_HIGH"
    ct = plans.volatility_crosstab(t, DAY).collect()[0]
    assert (ct["HIGH"], ct["VERY_HIGH"], ct["EXTREME"]) == (0, 1, 0)
