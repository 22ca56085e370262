"""Primary- and foreign-key roles of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.dialect import FOREIGN_KEY, PRIMARY_KEY
from lodestone.sources.catalog import Catalog

CONSTRAINT_KEY = ("connection_qn", "constraint_schema", "constraint_name", "table_schema", "table_name")
COLUMN_KEY = ("connection_qn", "table_schema", "table_name", "column_name")


def constraint_roles(catalog: Catalog) -> DataFrame:
    """One row per column that is in a primary or foreign key: constraint_type and constraint_name.

    A column in both is a primary key. The name is that of the primary key; a column that is only in foreign keys
    has none. Both relations are read once. Constraints are made distinct before the join, and the result is reduced
    to one row per column after it, both with map-side combining, so repeated source rows never multiply.
    """
    kinds = (
        catalog.table_constraints.where(F.col("constraint_type").isin(PRIMARY_KEY, FOREIGN_KEY))
        .select(*CONSTRAINT_KEY, (F.col("constraint_type") == PRIMARY_KEY).alias("is_pk"))
        .distinct()
    )
    usage = catalog.key_column_usage.select(*CONSTRAINT_KEY, "column_name")
    per_column = (
        usage.join(kinds, list(CONSTRAINT_KEY))
        .groupBy(*COLUMN_KEY)
        .agg(
            F.bool_or("is_pk").alias("is_pk"),
            F.min(F.when(F.col("is_pk"), F.col("constraint_name"))).alias("constraint_name"),
        )
    )
    return per_column.select(
        *COLUMN_KEY,
        F.when(F.col("is_pk"), PRIMARY_KEY).otherwise(FOREIGN_KEY).alias("constraint_type"),
        "constraint_name",
    )
