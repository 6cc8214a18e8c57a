"""Plan inspection through the public ``explain`` API (used by tests and by
``tools/plans.py``)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """The physical plan part of ``explain()``."""
    return plan_text(df, "simple")


def uses_python(df: DataFrame) -> bool:
    text = physical_plan(df)
    return any(op in text for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"))
