"""Plan inspection for tests and tuning (``explain`` text, no execution)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The ``explain`` output of ``df`` as a string."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (the figure the planner compares with
    ``spark.sql.autoBroadcastJoinThreshold``): the optimized plan's statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
