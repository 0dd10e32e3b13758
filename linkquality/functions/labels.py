"""Chart label clean-up (F11): ``avg_downstream_mbps`` -> ``Downstream``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: whole words removed from metric names before display.
NOISE = r"(?i)\b(avg|mbps|msec|percentage|total)\b"


def clean_label_col(c) -> Column:
    """Column form: underscores -> spaces, noise words dropped (any case),
    runs of blanks squeezed, then first letter upper and the rest lower."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.regexp_replace(F.translate(c, "_", " "), NOISE, "")
    s = F.trim(F.regexp_replace(s, r"\s+", " "))
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 20)))

