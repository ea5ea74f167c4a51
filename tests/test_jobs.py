"""The submit-able ingest and compact jobs, run in-process."""

import os

from ticklake.fixture import load_events, messages_from_events
from ticklake.jobs import parse_args, run
from ticklake.sources.compaction import fragmented_partitions
from ticklake.sources.scan import scan_ticks
from tests.conftest import SF_SMALL


def test_ingest_then_compact_jobs(spark, workdir):
    src = os.path.join(workdir, "in")
    msgs = messages_from_events(load_events(spark, SF_SMALL).where("day(ts) in (3, 15)"))
    msgs.select("value").repartition(3).write.text(src)
    table = os.path.join(workdir, "table")
    args = parse_args(["ingest", "--source-path", src, "--table", table,
                       "--dead-letters", os.path.join(workdir, "dead"),
                       "--checkpoint", os.path.join(workdir, "ckpt"),
                       "--max-per-trigger", "1", "--available-now"])
    run(args, spark)
    n = scan_ticks(spark, table).count()
    assert n > 0 and fragmented_partitions(spark, table).count() > 0
    res = run(parse_args(["compact", "--table", table, "--today", "2024-02-01"]), spark)
    assert {r["status"] for r in res} == {"compacted"}
    assert fragmented_partitions(spark, table).count() == 0
    assert scan_ticks(spark, table).count() == n
