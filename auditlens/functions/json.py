"""Scalars out of JSON: fields are parsed as VARIANT, which tells a text from an object or a list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def scalar(field: str) -> str:
    """SQL for the text of a VARIANT field; NULL for an object, a list or JSON null.

    The kind of a value is asked for only where its text may be that of an object or a list.
    """
    text = f"CAST({field} AS STRING)"
    nested = f"left({text}, 1) IN ('{{', '[') AND schema_of_variant({field}) <> 'STRING'"
    return f"CASE WHEN {nested} THEN NULL ELSE {text} END"


def scalars(document: str | Column, names: Sequence[str]) -> Column:
    """A struct of the scalar texts that a JSON object holds under the names, by one parse."""
    column = F.col(document) if isinstance(document, str) else document
    return F.from_json(column, ", ".join(f"`{name}` VARIANT" for name in names))
