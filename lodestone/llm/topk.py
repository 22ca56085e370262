"""The first rows of each key, also where one key has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 256


def first_rows(rows: DataFrame, key: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """`rows` with rank (int, from 1) of the first `k` of each key in this order. Each key's rows are dealt over `SALTS` parts
    first, of which `k` rows each go on, so a key's last step reads `k * SALTS` rows at most."""
    by_salt = Window.partitionBy(*key, "salt").orderBy(*order)
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    some = dealt.withColumn("place", F.row_number().over(by_salt)).where(F.col("place") <= k).drop("place", "salt")
    whole = Window.partitionBy(*key).orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)
