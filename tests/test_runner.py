import pytest

from ticklake.streaming.runner import finish


def test_a_missed_limit_stops_the_query_and_raises(spark):
    query = spark.readStream.format("rate").load().writeStream.format("noop").start()
    with pytest.raises(TimeoutError):
        finish(query, 1)
    assert not query.isActive
