"""Fixed output layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(
    df: DataFrame, names: Sequence[str], values: Mapping[str, Column], never_filled: Sequence[str] = ()
) -> DataFrame:
    """Select `names` in order after `connection_qn`; names in `never_filled` are NULL strings."""
    unexpected = set(names) ^ (set(values) | set(never_filled))
    if unexpected:
        raise ValueError(f"layout and values disagree on: {', '.join(sorted(unexpected))}")
    null = F.lit(None).cast("string")
    return df.select("connection_qn", *(values.get(name, null).alias(name) for name in names))
