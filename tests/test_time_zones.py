"""Every analytical query over a stored table gives the same instants in any session time zone."""

import os

import pytest
from pyspark.sql import functions as F

from ticklake import plans
from ticklake.fixture import load_events, messages_from_events
from ticklake.functions.timecols import bucket_of, utc_date, utc_text, utc_wall
from ticklake.operators.book import recent_quotes, top_of_book
from ticklake.operators.ingest import good_ticks, ingest, parse_received, parse_time
from ticklake.sources.scan import scan_ticks
from ticklake.sources.sinks import append_ticks, to_messages
from tests.conftest import SF_MID

DAY, MONTH, AS_OF = "2024-01-15", ("2024-01-10", "2024-01-20"), "2024-01-15 12:00:00"
SYMS = ["click", "error", "view"]
QUERIES = {
    "high_low": lambda t: plans.high_low(t, SYMS, "1h", AS_OF),
    "latest_prices": lambda t: plans.latest_prices(t, SYMS, 3, AS_OF),
    "quickvwap": lambda t: plans.quickvwap(t, DAY),
    "vwap": lambda t: plans.vwap(t, SYMS, "30m", AS_OF),
    "returns": lambda t: plans.returns(t, None, MONTH),
    "volatility": lambda t: plans.volatility(t, None, MONTH),
    "correlation": lambda t: plans.correlation(t, "click", "error", MONTH, unit="hour"),
    "dataset": lambda t: plans.dataset(t, DAY),
    "day_extract": lambda t: plans.day_extract(t, DAY),
    "dense": lambda t: plans.resample_mean(t, DAY, dense=True),
    "levels": lambda t: plans.volatility_levels(t, MONTH),
    "gaps": lambda t: plans.gap_series(t, DAY),
    "describe": lambda t: plans.describe_ticks(t, DAY, columns=["price"]),
    "book": top_of_book,
    "quotes": recent_quotes,
    "messages": to_messages,
}
ZONES = ["UTC", "America/New_York", "Asia/Kolkata"]


def _comparable(df):
    cols = [utc_text(F.col(f.name), f.dataType) if "timestamp" in f.dataType.simpleString() else F.round(f.name, 9) if f.dataType.simpleString() == "double" else F.col(f.name)
            for f in df.schema.fields]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture()
def zone(spark):
    yield lambda z: spark.conf.set("spark.sql.session.timeZone", z)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_queries_do_not_depend_on_the_session(spark, workdir, zone):
    found = {}
    events = load_events(spark, SF_MID).where("day(ts) between 14 and 16")
    for z in ZONES:
        zone(z)
        root = os.path.join(workdir, z.replace("/", "-"))
        append_ticks(good_ticks(ingest(messages_from_events(events))), root, "b")
        ticks = scan_ticks(spark, root)
        assert sorted({r["day"] for r in ticks.select("day").distinct().collect()}) == [14, 15, 16]
        for name, q in QUERIES.items():
            rows = _comparable(q(ticks))
            assert rows and found.setdefault(name, rows) == rows, (name, z)
    assert len(found["day_extract"]) > 200


@pytest.mark.parametrize("z", ZONES)
def test_clock_changes(spark, zone, z):
    """Wall clocks that New York skips or has twice stay what they are."""
    zone(z)
    texts = {"2024-03-10T02:30:15.5Z": "2024-03-10 02:30:15.500000", "2024-03-10 02:30:15": "2024-03-10 02:30:15.000000", "2024-03-10": "2024-03-10 00:00:00.000000",
             "2024-03-10T02:30:15+05:30": "2024-03-09 21:00:15.000000", "2024-11-03 01:30:00.123456": "2024-11-03 01:30:00.123456",
             "1969-12-31 23:59:59.5Z": "1969-12-31 23:59:59.500000", "12:00": None, "never": None, None: None}
    d = spark.createDataFrame([(t,) for t in texts], "t string").select("t", parse_time(F.col("t")).alias("time"))
    d = d.withColumn("wall", utc_wall(F.col("time"), d.schema["time"].dataType))
    for c in ("time", "wall"):
        kind = d.schema[c].dataType
        rows = d.select("t", utc_text(F.col(c), kind), utc_date(F.col(c), kind).cast("string"),
                        *[utc_text(bucket_of(d, u, c), kind) for u in ("minute", "hour", "day")]).collect()
        for t, text, day, minute, hour, whole in rows:
            want = texts[t]
            assert (text, day) == (want, want and want[:10])
            if want:
                assert (minute, hour, whole) == (want[:16] + ":00.000000", want[:13] + ":00:00.000000", want[:10] + " 00:00:00.000000")
    got = spark.createDataFrame([("10-03-2024 02:30:15.000001",), ("32-03-2024 02:30:15.000001",), ("10-03-2024 02:30",)], "t string").select(parse_received(F.col("t")).cast("string")).collect()
    assert [r[0] for r in got] == ["2024-03-10 02:30:15.000001", None, None]
