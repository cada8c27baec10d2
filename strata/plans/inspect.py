"""Plan text for assertions: what Catalyst chose, without running the query."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The physical plan as ``df.explain(mode)`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def count_nodes(plan: str, node: str) -> int:
    """Number of physical operators named ``node`` in a formatted plan."""
    return len(re.findall(rf"^\(\d+\) {re.escape(node)}\b", plan, flags=re.MULTILINE))
