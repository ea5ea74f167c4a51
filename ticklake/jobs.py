"""Submit-able jobs: ``python -m ticklake.jobs ingest|compact ...`` (or spark-submit).

``ingest`` runs SS3: the tick stream (Kafka topics ``market-data-*`` or a
folder of JSON-line files) into the partitioned table, with dead letters
and metrics, checkpointed. ``compact`` runs SNK4 once over every past day
with fragments. Scheduling (how often compaction runs) belongs to the
cluster's scheduler, not to this package.
"""

from __future__ import annotations

import argparse
import json
from datetime import date, datetime, timezone

from ticklake.session import build_session
from ticklake.sources.compaction import compact_table
from ticklake.sources.stream import read_tick_stream
from ticklake.streaming.ingest_stream import start_ingest


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ticklake.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    i = sub.add_parser("ingest", help="stream ticks into the table")
    src = i.add_mutually_exclusive_group(required=True)
    src.add_argument("--bootstrap-servers")
    src.add_argument("--source-path")
    i.add_argument("--table", required=True)
    i.add_argument("--dead-letters", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--metrics")
    i.add_argument("--max-per-trigger", type=int, default=5_000_000, help="messages (Kafka) or files of a micro-batch at most")
    # each micro-batch leaves a directory for each day and symbol
    i.add_argument("--trigger", default="5 minutes", help="processing-time trigger")
    i.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    c = sub.add_parser("compact", help="compact past days with fragments")
    c.add_argument("--table", required=True)
    c.add_argument("--today", help="YYYY-MM-DD; default: today (UTC)")
    c.add_argument("--target-mb", type=int, default=256, help="size that files are packed to")
    p.add_argument("--local", help="local master for trying it out, e.g. local[4]")
    return p.parse_args(argv)


def run(args: argparse.Namespace, spark=None):
    spark = spark or build_session(args.local, app=f"ticklake-{args.job}", cluster=not args.local)
    if args.job == "ingest":
        stream = read_tick_stream(spark, bootstrap_servers=args.bootstrap_servers,
                                  path=args.source_path, max_per_trigger=args.max_per_trigger)
        q = start_ingest(stream, args.table, args.dead_letters, args.checkpoint, args.metrics,
                         available_now=args.available_now,
                         processing_time=None if args.available_now else args.trigger)
        q.awaitTermination()
        return q.lastProgress
    today = date.fromisoformat(args.today) if args.today else datetime.now(timezone.utc).date()
    return compact_table(spark, args.table, today=today, target_bytes=args.target_mb << 20)


def main(argv=None) -> None:
    print(json.dumps(run(parse_args(argv)), default=str))


if __name__ == "__main__":
    main()
