"""Qualified names: the path strings that identify every entity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: path segment between a schema and its routines.
PROCEDURES_SEGMENT = "_procedures_"


def path(*parts: Column | str) -> Column:
    """Join path segments with '/'; plain strings are literals. NULL in any part gives NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("/"))
        pieces.append(F.lit(part) if isinstance(part, str) else part)
    return F.concat(*pieces)


def procedure_path(schema_qn: Column, name: Column) -> Column:
    """Routines live under their own segment; procedures and functions share it."""
    return path(schema_qn, PROCEDURES_SEGMENT, name)


def connector_of(connection_qn: Column) -> Column:
    """Connector name: the second segment of `tenant/connector/epoch`."""
    return F.split_part(connection_qn, F.lit("/"), F.lit(2))
