"""Column-level building blocks: decode, encode, time parsing, text, hashing."""

from .decode import decode_records, parse_event_time, rejects, valid_events
from .encode import encode_records, iso_utc, wire_json
from .hashing import hash_select_items
from .text import fmt_int, fmt_money, pad_left, pad_right, sql_list, ts19, zero_pad_sql

__all__ = [
    "decode_records",
    "parse_event_time",
    "rejects",
    "valid_events",
    "encode_records",
    "iso_utc",
    "wire_json",
    "hash_select_items",
    "fmt_int",
    "fmt_money",
    "pad_left",
    "pad_right",
    "ts19",
    "sql_list",
    "zero_pad_sql",
]
