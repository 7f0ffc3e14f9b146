"""Columns by their literal name, and what their types allow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """A column name as an SQL identifier, dots and back ticks included."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """A text as an SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    """The column of this name."""
    return F.col(quoted(name))


def names_of(by: str | Sequence[str]) -> list[str]:
    """One name or several, as a list."""
    return [by] if isinstance(by, str) else list(by)


def comparable(kind: T.DataType) -> bool:
    """Whether values of this type can be told apart by grouping."""
    if isinstance(kind, T.ArrayType):
        return comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(comparable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
