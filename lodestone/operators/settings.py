"""Key/value setting rows folded into settings: the last value of a key wins, `extra.` keys are nested."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: prefix of nested keys.
EXTRA_PREFIX = "extra."


def latest_settings(rows: DataFrame, owner: str = "connection_qn", order: str = "seq") -> DataFrame:
    """One row per owner, section ('' or 'extra') and key, with the value that came last.

    Rows are (owner, key, value, order). Only the last value per key is kept while combining, so neither a busy
    owner nor a busy key is gathered anywhere. Not meant for secrets.
    """
    nested = F.col("key").startswith(EXTRA_PREFIX)
    return (
        rows.groupBy(owner, "key")
        .agg(F.max_by("value", order).alias("value"))
        .select(
            owner,
            F.when(nested, "extra").otherwise("").alias("section"),
            F.when(nested, F.substring("key", len(EXTRA_PREFIX) + 1, 2**31 - 1)).otherwise(F.col("key")).alias("key"),
            "value",
        )
    )


def settings_map(rows: DataFrame, owner: str = "connection_qn", order: str = "seq") -> DataFrame:
    """One row per owner: the map `settings` of its plain keys and the map `extra` of its nested ones, last values only.

    Gathered after the reduction, so an owner's maps hold each key once, however often it was set.
    """
    entry, nested = F.struct("key", "value"), F.col("section") == "extra"
    return latest_settings(rows, owner, order).groupBy(owner).agg(
        F.map_from_entries(F.collect_list(F.when(~nested, entry))).alias("settings"),
        F.map_from_entries(F.collect_list(F.when(nested, entry))).alias("extra"),
    )
