"""Relational operators of the event analytics engine."""

from .freshness import summary_freshness
from .generate import generate_events
from .quality import decode_quality, quality_counters
from .reports import events_per_window, formatted, last_period, latest, revenue_by_category, totals, with_total
from .tumble import SUMMARY_COLUMNS, tumbling_summary

__all__ = [
    "summary_freshness",
    "generate_events",
    "decode_quality",
    "quality_counters",
    "events_per_window",
    "formatted",
    "last_period",
    "latest",
    "revenue_by_category",
    "totals",
    "with_total",
    "SUMMARY_COLUMNS",
    "tumbling_summary",
]
