"""Reading physical plans: used by tests and by anyone checking that a
filter reached the scan, how many shuffles a query has, or that no Python
UDF slipped into a plan."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def count_nodes(df: DataFrame, name: str) -> int:
    """Number of physical operators called ``name`` in the plan tree (the
    initial plan when AQE is on)."""
    tree = plan_text(df).split("\n\n\n")[0]
    return len(re.findall(rf"(?:^|[\s:+\-*]){re.escape(name)} \(\d+\)", tree, flags=re.M))
