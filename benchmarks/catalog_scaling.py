"""How the extracts grow with the number of connections, on stored relations.

    python benchmarks/catalog_scaling.py <sf_dir> <scratch_dir> 1 10 40

Writes `n` copies of the derived catalog (one connection each) as Parquet below the scratch directory, then times the
extracts on it, once to warm up and once to measure; up to 10 connections also a full delivery. Also times the key roles as three scalar subqueries, one per question, against
the single pre-aggregate the library uses.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import functions as F  # noqa: E402

from lodestone.operators import inventory as I  # noqa: E402
from lodestone.operators.constraints import constraint_roles  # noqa: E402
from lodestone.plans.extraction import EntityStreams, extract  # noqa: E402
from lodestone.session import local_session  # noqa: E402
from lodestone.sources.catalog import RELATION_SCHEMAS, catalog_from, read_parquet_catalog, write_parquet_catalog  # noqa: E402
from lodestone.sources.derived import DerivedCatalog  # noqa: E402

_IN_KEY = """(select min({what}) from usage u join constraints k
      using (connection_qn, constraint_schema, constraint_name, table_schema, table_name)
    where k.constraint_type = '{kind}' and u.connection_qn = c.connection_qn and u.table_schema = c.table_schema
      and u.table_name = c.table_name and u.column_name = c.column_name)"""


def copies(catalog, n: int):
    numbers = F.explode(F.sequence(F.lit(1), F.lit(n))).alias("n")
    copied = {}
    for name in RELATION_SCHEMAS:
        df = getattr(catalog, name)
        own = [c for c in df.columns if c != "connection_qn"]
        copied[name] = df.select(numbers, *own).select(
            F.concat(F.lit("default/mysql/"), F.col("n").cast("string")).alias("connection_qn"), *own
        )
        copied[name] = copied[name].repartition(max(8, n))
    return catalog_from(copied)


def warm_seconds(build) -> float:
    seconds = 0.0
    for _ in range(2):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
    return round(seconds, 2)


def subquery_roles(spark, catalog):
    catalog.columns.createOrReplaceTempView("source_columns")
    catalog.key_column_usage.createOrReplaceTempView("usage")
    catalog.table_constraints.createOrReplaceTempView("constraints")
    primary, foreign = (_IN_KEY.format(what="k.constraint_type", kind=k) for k in ("PRIMARY KEY", "FOREIGN KEY"))
    name = _IN_KEY.format(what="u.constraint_name", kind="PRIMARY KEY")
    return spark.sql(f"""select connection_qn, table_schema, table_name, column_name, coalesce({primary}, {foreign}) as constraint_type,
        {name} as constraint_name from source_columns c""")


def joined_roles(catalog):
    keys = ["connection_qn", "table_schema", "table_name", "column_name"]
    return catalog.columns.select(*keys).join(constraint_roles(catalog), keys, "left")


def main(sf_dir: str, scratch: str, sizes: list[int]) -> None:
    spark = local_session("scaling", **{"spark.ui.showConsoleProgress": "false"})
    for n in sizes:
        root = f"{scratch}/copies_{n}"
        write_parquet_catalog(copies(DerivedCatalog(spark, sf_dir), n), root)
        catalog = read_parquet_catalog(spark, root)
        streams = EntityStreams(catalog)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(8, 4 * n)))
        print(f"connections {n}, column rows {catalog.columns.count():,}", flush=True)
        for label, build in {
            "schema_inventory": lambda: I.schema_inventory(catalog),
            "table_inventory": lambda: I.table_inventory(catalog),
            "column_inventory": lambda: I.column_inventory(catalog),
            "entity_column": lambda: streams["column"],
            "key roles, one pre-aggregate": lambda: joined_roles(catalog),
            "key roles, three subqueries": lambda: subquery_roles(spark, catalog),
        }.items():
            print(f"  {label}: {warm_seconds(build)} s", flush=True)
        if n > 10:
            continue
        start = time.perf_counter()
        delivery = extract(spark, catalog, f"{scratch}/out_{n}")
        print(f"  full delivery, {sum(delivery.lines.values()):,} lines: {time.perf_counter() - start:.2f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], [int(a) for a in sys.argv[3:]])
