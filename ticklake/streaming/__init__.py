"""Structured Streaming jobs: ingest (SS3) and the book (SS1, SS2)."""

from ticklake.streaming.ingest_stream import start_ingest  # noqa: F401
from ticklake.streaming.subscribed import (  # noqa: F401
    add_subscriptions, remove_subscriptions, start_subscribed, subscriptions)
from ticklake.streaming.book_stream import stream_recent_quotes, stream_top_of_book  # noqa: F401
