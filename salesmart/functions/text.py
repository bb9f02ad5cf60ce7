"""Splitting composite text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: the parts of a product key, in order ----
MOBILE_KEY_PARTS = ("Brand", "Model", "Color", "Memory")


def mobile_key_parts(key: Column) -> dict[str, Column]:
    """Brand, model, color and memory of a '/'-separated key; a missing part is NULL."""
    parts = F.split(key, "/")
    return {name: F.get(parts, F.lit(i)) for i, name in enumerate(MOBILE_KEY_PARTS)}
