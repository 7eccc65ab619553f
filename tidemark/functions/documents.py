"""Reading values out of JSON documents held as variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_at(doc: str, path: str) -> Column:
    """Scalar at a path, as text. Absent and JSON null are both NULL."""
    return F.try_variant_get(doc, path, "string")


def value_at(doc: str, path: str, dtype: str) -> Column:
    """Scalar at a path through its text form, so 17 and "17" read the same."""
    return text_at(doc, path).try_cast(dtype)


def texts_in(doc: str, path: str, field: str) -> Column:
    """One text field of every object in the list at a path, in document order.

    An absent list and an empty list are both NULL.
    """
    items = F.try_variant_get(doc, path, f"array<struct<{field}:string>>")
    return F.when(F.size(items) > 0, F.transform(items, lambda item: item[field]))
