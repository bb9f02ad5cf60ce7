"""Typed reads of text: a value that does not fit its type becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.config import WHOLE


def typed(value: Column, type_name: str) -> Column:
    """``value`` as ``type_name``, NULL where the text is not such a value."""
    return value.try_cast(type_name)


def to_number(value: Column, scale: int = 0) -> Column:
    """A number of 38 digits; without a scale it is rounded half up to a whole number."""
    return value.try_cast(WHOLE if scale == 0 else f"decimal(38,{scale})")


def failed_cast(raw: Column, type_name: str) -> Column:
    """True where there is a raw value and it does not fit ``type_name``."""
    return raw.isNotNull() & raw.try_cast(type_name).isNull()


def json_field(document: Column, field: str, type_name: str = "string") -> Column:
    """A top-level field of JSON text; NULL for a missing field or malformed text."""
    path = '$["' + field + '"]'
    return F.try_variant_get(F.try_parse_json(document), path, type_name)
