"""SNK1/SNK4/SNK5 and SRC1/SRC2 over a table written by the ingest path."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ticklake.fixture import load_events, messages_from_events
from ticklake.sources import compaction
from ticklake.sources.compaction import compact_day, compact_days, compact_table, folded_days, fragmented_partitions, left_over
from ticklake.sources.layout import listing
from ticklake.sources.scan import scan_day, scan_range, scan_ticks
from ticklake.streaming.ingest_stream import ingest_batch
from tests.conftest import SF_SMALL


def _messages(spark, batches=3):
    events = load_events(spark, SF_SMALL).where("day(ts) in (14, 15, 16, 20)")
    return messages_from_events(events).withColumn("_b", F.crc32("value") % batches)


def _table(spark, workdir, batches=3):
    table, dead = os.path.join(workdir, "t"), os.path.join(workdir, "d")
    msgs = _messages(spark, batches)
    for b in range(batches):
        ingest_batch(msgs.where(F.col("_b") == b).drop("_b"), b, table, dead)
    return table


def _rows(df):
    return sorted(tuple(r) for r in df.select("sequence", "product_id", "price", "time", "recieved").collect())


LATER = date(2024, 2, 1)


def test_compaction_keeps_rows_and_is_idempotent(spark, workdir):
    table = _table(spark, workdir)
    before = _rows(scan_ticks(spark, table))
    assert fragmented_partitions(spark, table).where("year = 2024 AND month = 1 AND day = 15").count() > 0
    assert compact_day(spark, table, "2024-01-15", today=LATER)["status"] == "compacted"
    assert _rows(scan_ticks(spark, table)) == before
    assert fragmented_partitions(spark, table, days="2024-01-15").count() == 0
    batches = {r["batch"] for r in listing(spark, table, "2024-01-15").select("batch").collect()}
    assert len(batches) == 1 and batches.pop().startswith("c")
    assert not os.path.exists(os.path.join(table, "_staging", "x")) and os.listdir(os.path.join(table, "_staging")) == []

    assert compact_day(spark, table, "2024-01-15", today=LATER)["status"] == "already-compact"
    assert compact_day(spark, table, "2024-03-01", today=date(2024, 4, 1))["status"] == "missing"
    assert _rows(scan_ticks(spark, table)) == before
    assert compact_day(spark, table, "2024-01-16", today=date(2024, 1, 16))["status"] == "skipped-today"
    assert fragmented_partitions(spark, table).where("day = 16").count() > 0


def test_replay_after_compaction_adds_nothing(spark, workdir):
    table, dead = _table(spark, workdir), os.path.join(workdir, "d")
    before = _rows(scan_ticks(spark, table))
    compact_table(spark, table, today=date(2024, 1, 20))
    msgs = _messages(spark)
    ingest_batch(msgs.where("_b = 1").drop("_b"), 1, table, dead)
    assert _rows(scan_ticks(spark, table)) == before
    # compacted again, the first batches are two compactions away
    ingest_batch(msgs.where("_b = 0").drop("_b"), 9, table, dead)
    before = _rows(scan_ticks(spark, table))
    assert "compacted" in {r["status"] for r in compact_table(spark, table, today=LATER)}
    assert _rows(scan_ticks(spark, table)) == before and fragmented_partitions(spark, table).count() == 0
    assert date(2024, 1, 15) in folded_days(spark, table, "b" + "0" * 12)
    for b in (0, 2):
        ingest_batch(msgs.where(F.col("_b") == b).drop("_b"), b, table, dead)
    assert _rows(scan_ticks(spark, table)) == before


@pytest.mark.parametrize("step", ["_publish", "_delete"])
def test_a_run_that_ends_early_loses_and_doubles_nothing(spark, workdir, monkeypatch, step):
    table, dead = _table(spark, workdir), os.path.join(workdir, "d")
    before = _rows(scan_ticks(spark, table))
    calls, real = [], getattr(compaction, step)

    def end(sp, *args):
        calls.append(args)
        # the first deletion is that of left-overs, here none
        if len(calls) == 2:
            raise OSError("the driver is gone")
        return real(sp, *args)

    with monkeypatch.context() as m:
        m.setattr(compaction, step, end)
        with pytest.raises(OSError):
            compact_days(spark, table, ("2024-01-14", "2024-01-16"), today=LATER)
    assert _rows(scan_ticks(spark, table, settled=True)) == before
    # what was published counts, what was not does not
    left = {r["day"] for r in left_over(spark, table).collect()}
    assert left == ({14} if step == "_publish" else {14, 15, 16})
    raw = _messages(spark).where("_b = 1").drop("_b")
    ingest_batch(raw, 1, table, dead)
    assert _rows(scan_ticks(spark, table, settled=True)) == before
    compact_table(spark, table, today=LATER)
    assert _rows(scan_ticks(spark, table)) == before and left_over(spark, table).count() == 0


def test_a_hot_symbol_day_becomes_files_in_order_of_time(spark, workdir):
    from ticklake.fixture import fixture_ticks
    from ticklake.sources.sinks import append_ticks

    root = os.path.join(workdir, "hot")
    t = fixture_ticks(spark, "/root/testdata/sf0.1").where("day = 3")
    for b in range(4):
        append_ticks(t.where(F.col("sequence") % 4 == b), root, f"b{b}")
    before = _rows(scan_ticks(spark, root))
    files = {r["product_id"]: r["bytes"] for r in fragmented_partitions(spark, root).collect()}
    target = max(files.values()) // 5
    # files above a quarter of the target are finished: with this one, all are fragments
    compact_days(spark, root, ["2024-01-03"], LATER, target_bytes=target * 4)
    assert fragmented_partitions(spark, root, target * 4).count() == 0
    append_ticks(t.where("sequence < 0"), root, "late")
    assert _rows(scan_ticks(spark, root)) == before
    big = os.path.join(workdir, "big")
    for b in range(16):
        append_ticks(t.where(F.col("sequence") % 16 == b), big, f"b{b}")
    size = {r["product_id"]: r["bytes"] for r in listing(spark, big).groupBy("product_id").agg(F.sum("length").alias("bytes")).collect()}
    # sixteen fragments of about a sixteenth each, so that every one is below a quarter of a third
    assert compact_days(spark, big, ["2024-01-03"], LATER, target_bytes=min(size.values()) // 3)[date(2024, 1, 3)]["status"] == "compacted"
    assert _rows(scan_ticks(spark, big)) == before
    spans = (scan_ticks(spark, big).groupBy("product_id", F.col("_metadata.file_path").alias("f"))
             .agg(F.min("time").alias("lo"), F.max("time").alias("hi"), F.count("*").alias("n")).orderBy("product_id", "lo").collect())
    assert len(spans) > len(size)
    for a, b in zip(spans, spans[1:]):
        assert a["product_id"] != b["product_id"] or a["hi"] <= b["lo"]
    assert fragmented_partitions(spark, big, min(size.values()) // 3).count() == 0


def test_finished_files_are_left_alone(spark, workdir):
    table, dead = _table(spark, workdir), os.path.join(workdir, "d")
    compact_day(spark, table, "2024-01-15", today=LATER)
    one = listing(spark, table, "2024-01-15").agg(F.min("length")).first()[0]
    msgs = _messages(spark)
    for b in (7, 8):
        ingest_batch(msgs.where("_b = 0").drop("_b"), b, table, dead)
    before = _rows(scan_ticks(spark, table))
    paths = {r["path"] for r in listing(spark, table, "2024-01-15").filter("batch like 'c%'").collect()}
    # the compacted files are a quarter of this target or more, the micro-batches' are not
    small = listing(spark, table, "2024-01-15").filter("batch not like 'c%'").agg(F.max("length")).first()[0]
    if small < one:
        compact_day(spark, table, "2024-01-15", today=LATER, target_bytes=one * 4)
        assert paths <= {r["path"] for r in listing(spark, table, "2024-01-15").collect()}
    assert _rows(scan_ticks(spark, table)) == before


def test_only_the_asked_days_are_listed(spark, workdir):
    table = _table(spark, workdir)
    whole, part = scan_ticks(spark, table), scan_ticks(spark, table, ("2024-01-14", "2024-01-15"))
    assert {f.split("/day=")[1].split("/")[0] for f in part.inputFiles()} == {"14", "15"} and len(part.inputFiles()) < len(whole.inputFiles())
    assert _rows(part) == _rows(whole.where("day in (14, 15)")) and part.columns == whole.columns
    assert scan_ticks(spark, table, "2030-01-01").collect() == [] and scan_ticks(spark, workdir + "/no", settled=True).collect() == []


def test_scan_prunes_partitions_and_pushes_time(spark, workdir):
    table = _table(spark, workdir, batches=1)
    t = scan_ticks(spark, table)
    q = scan_day(t, "2024-01-15", "click")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan and "product_id" in plan
    assert "PushedFilters: [" in plan and "time" in plan
    pf = plan[plan.index("PartitionFilters: ["):]
    pf = pf[:pf.index("]")]
    assert "year" in pf and "day" in pf and "product_id" in pf
    n_files = q.select(F.col("_metadata.file_path")).distinct().count()
    assert n_files == 1
    assert q.where(F.col("product_id") != "click").count() == 0
    r = scan_range(t, "2024-01-14", "2024-01-16")
    days = {x[0] for x in r.select("day").distinct().collect()}
    assert days <= {14, 15, 16}


def test_compact_table_skips_today(spark, workdir):
    table = _table(spark, workdir, batches=2)
    before = _rows(scan_ticks(spark, table))
    res = compact_table(spark, table, today=date(2024, 1, 20))
    status = {r["day"]: r["status"] for r in res}
    assert status["2024-01-14"] == "compacted"
    assert status["2024-01-20"] == "skipped-today"
    assert _rows(scan_ticks(spark, table)) == before
    left = {r[0] for r in fragmented_partitions(spark, table).select("day").distinct().collect()}
    assert left <= {20}


def test_plain_appends_accumulate(spark, workdir):
    from ticklake.fixture import fixture_ticks
    from ticklake.sources.sinks import append_ticks

    t = fixture_ticks(spark, SF_SMALL).where("day = 3")
    root = os.path.join(workdir, "plain")
    append_ticks(t, root)
    append_ticks(t, root)
    back = scan_ticks(spark, root)
    assert back.count() == 2 * t.count()
    assert back.where("time IS NULL").count() == 0


def test_stale_staging_is_cleaned(spark, workdir, monkeypatch):
    table = _table(spark, workdir, batches=2)
    before = _rows(scan_ticks(spark, table))

    def end(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(compaction, "_publish", end)
        with pytest.raises(OSError):
            compact_day(spark, table, "2024-01-15", today=LATER)
    assert os.listdir(os.path.join(table, "_staging"))
    compact_table(spark, table, today=date(2024, 1, 16), staging_max_age_hours=0)
    assert os.listdir(os.path.join(table, "_staging")) == []
    assert _rows(scan_ticks(spark, table)) == before


def test_late_batch_survives_compaction(spark, workdir, monkeypatch):
    from ticklake.sources.sinks import append_ticks

    table = _table(spark, workdir)
    late = [r.asDict() for r in scan_ticks(spark, table).where("day = 15").collect()]
    late = spark.createDataFrame(late, scan_ticks(spark, table).schema)
    before = scan_ticks(spark, table).count()
    publish = compaction._publish

    def land_then_publish(*args):
        append_ticks(late, table, "late")
        publish(*args)

    monkeypatch.setattr(compaction, "_publish", land_then_publish)
    assert compact_day(spark, table, "2024-01-15", today=LATER)["status"] == "compacted"
    assert scan_ticks(spark, table).count() == before + late.count()


def test_wrong_counts_leave_the_day_alone(spark, workdir, monkeypatch):
    table = _table(spark, workdir)
    before = _rows(scan_ticks(spark, table))
    monkeypatch.setattr(compaction, "_packed", lambda rows, *_: rows.limit(1))
    with pytest.raises(RuntimeError):
        compact_day(spark, table, "2024-01-15", today=LATER)
    assert _rows(scan_ticks(spark, table)) == before


def test_two_owners_share_a_table(spark, workdir):
    from ticklake.sources.sinks import append_ticks
    from ticklake.streaming.ingest_stream import batch_name

    table = _table(spark, workdir)
    rows = [r.asDict() for r in scan_ticks(spark, table).collect()]
    rows = spark.createDataFrame(rows, scan_ticks(spark, table).schema)
    for owner in ("a1", "b2", "a1"):
        append_ticks(rows, f"{workdir}/two", batch_name(0, owner))
    assert scan_ticks(spark, f"{workdir}/two").count() == 2 * rows.count()
