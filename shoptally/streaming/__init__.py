"""Structured Streaming forms of the ledger: duplicate guard, scoring, weekly revenue."""

from shoptally.streaming.ledger_stream import (
    dedupe_stream,
    latest_per_key,
    run_available,
    run_closed,
    score_batch,
    score_stream,
    table_stream,
    weekly_revenue_stream,
)

__all__ = [
    "dedupe_stream",
    "latest_per_key",
    "run_available",
    "run_closed",
    "score_batch",
    "score_stream",
    "table_stream",
    "weekly_revenue_stream",
]
