"""Fixed-width report text, built from JVM string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad_right(c: Column, width: int) -> Column:
    """Left-aligned in ``width`` chars; longer text is kept whole."""
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, " "))


def pad_left(c: Column, width: int) -> Column:
    """Right-aligned in ``width`` chars; longer text is kept whole."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, " "))


def fmt_int(c: Column) -> Column:
    """1234567 -> ``1,234,567``."""
    return F.format_number(c, 0)


def fmt_money(c: Column) -> Column:
    """1234.5 -> ``1,234.50``."""
    return F.format_number(c, 2)


def ts19(c: Column) -> Column:
    """Timestamp as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def sql_list(values) -> str:
    """Body of a SQL array/list literal, e.g. ``'a', 'b'`` or ``1, 2``."""
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def zero_pad_sql(expr: str, width: int) -> str:
    """SQL text: integer as zero-padded text (wider values kept whole, like
    ``%0Nd``); far cheaper per row than ``format_string``."""
    text = f"CAST({expr} AS STRING)"
    return f"IF(length({text}) >= {width}, {text}, lpad({text}, {width}, '0'))"
