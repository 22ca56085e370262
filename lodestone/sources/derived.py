"""A source catalog derived from the supplied test tables (FIXTURES.md section 4).

One order is one table, one line item one column, one document one routine. With `connections=k`, customers (and
documents) are spread over k connections that all have the same schema names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestone.sources.catalog import RELATION_SCHEMAS, Catalog, in_part

CONNECTION_PREFIX = "default/mysql/"

_PLACE = ("connection_qn", "table_schema", "table_name")

_SCHEMA_NAME = """case n_nationkey when 0 then 'mysql' when 1 then 'performance_schema'
    when 2 then 'information_schema' when 3 then 'sys' else n_name end"""

_TABLE_VALUES = {
    "table_catalog": "'def'",
    "table_type": """case o_orderstatus when 'F' then 'BASE TABLE' when 'O' then 'VIEW'
        else if(o_orderkey % 2 = 0, 'SYSTEM VERSIONED', 'SYSTEM VIEW') end""",
    "engine": "if(o_orderstatus = 'O', null, 'InnoDB')",
    "version": "if(o_orderstatus = 'O', null, 10)",
    "row_format": "if(o_orderstatus = 'O', null, 'Dynamic')",
    "table_rows": "if(o_orderstatus = 'O', null, floor(o_totalprice))",
    "data_length": "if(o_orderstatus = 'O', null, o_custkey * 1024)",
    "index_length": "if(o_orderkey % 7 = 0, null, o_orderkey * 16)",
    "auto_increment": "if(o_orderstatus = 'F', o_orderkey + 1, null)",
    "create_time": "o_orderdate",
    "table_collation": "if(o_orderstatus = 'O', null, 'utf8mb4_0900_ai_ci')",
    "create_options": "if(o_orderkey % 10 = 0, 'partitioned', '')",
    "table_comment": "case o_orderkey % 4 when 0 then '' when 1 then null else o_orderpriority end",
}

_KIND = "(l_orderkey + l_linenumber) % 6"

_COLUMN_VALUES = {
    "table_catalog": "'def'",
    "column_name": "concat('c', l_linenumber)",
    "ordinal_position": "l_linenumber",
    "column_default": "if(l_linenumber = 4, '0', null)",
    "is_nullable": "if(l_linenumber <= 2, 'NO', 'YES')",
    "data_type": f"""element_at(array('int', 'varchar', 'decimal', 'timestamp', 'enum', 'json'),
        int({_KIND} + 1))""",
    "character_maximum_length": f"case {_KIND} when 1 then 100 when 4 then 20 end",
    "character_octet_length": f"case {_KIND} when 1 then 400 when 4 then 80 end",
    "numeric_precision": f"case {_KIND} when 0 then 10 when 2 then 12 end",
    "numeric_scale": f"case {_KIND} when 0 then 0 when 2 then 2 end",
    "character_set_name": f"if({_KIND} in (1, 4), 'utf8mb4', null)",
    "collation_name": f"if({_KIND} in (1, 4), 'utf8mb4_0900_ai_ci', null)",
    "column_type": f"""element_at(array('int', 'varchar(100)', 'decimal(12,2)', 'timestamp', 'enum(a,b)', 'json'),
        int({_KIND} + 1))""",
    "column_key": """case when l_linenumber = 1 then 'PRI' when l_linenumber = 2 and l_orderkey % 3 = 0 then 'MUL'
        when l_linenumber = 3 then 'UNI' else '' end""",
    "extra": "if(l_linenumber = 1, 'auto_increment', '')",
    "privileges": "'select,insert,update,references'",
    "column_comment": "case l_linenumber % 3 when 0 then '' when 1 then null else concat('line ', l_linenumber) end",
    "generation_expression": "case l_linenumber when 6 then null when 7 then 'c1 + 1' else '' end",
}

_CONSTRAINT_NAMES = """array_compact(array(if(l_linenumber = 1, 'PRIMARY', null),
    if(l_linenumber <= 2 and l_orderkey % 3 = 0, concat('fk_', l_linenumber), null),
    if(l_linenumber = 3, 'uk_3', null)))"""


@lru_cache
def _schema_of(application: str, path: str) -> StructType:
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table; its schema is read from the file once per application."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema_of(spark.sparkContext.applicationId, path)).parquet(path)


def _connection(key: Column, connections: int) -> Column:
    return F.concat(F.lit(CONNECTION_PREFIX), (F.pmod(key, F.lit(connections)) + 1).cast("string"))


def _shaped(df: DataFrame, relation: str, **values: Column | str) -> DataFrame:
    """Give a DataFrame the layout of a relation; values not given are taken by name, or are NULL."""
    exprs = {k: F.expr(v) if isinstance(v, str) else v for k, v in values.items()}
    own = set(df.columns)

    def value(name: str) -> Column:
        if name in exprs:
            return exprs[name]
        return F.col(name) if name in own else F.lit(None)

    return df.select(*(value(f.name).cast(f.dataType).alias(f.name) for f in RELATION_SCHEMAS[relation].fields))


def on_order() -> Column:
    return F.col("l_orderkey") == F.col("o_orderkey")


class DerivedCatalog(Catalog):
    """All source relations from the Parquet tables in `sf_dir`, each built when it is first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, connections: int = 1, part: tuple[int, int] = (0, 1)):
        self._spark, self._sf_dir, self._n, self._part = spark, sf_dir, connections, part

    def part(self, part: int, parts: int) -> Catalog:
        """One of `parts` parts of the tables, with all rows that are of them (`catalog.part_of`). Tables of one name are of one order, so
        that other orders and their line items need not be moved to find out."""
        return DerivedCatalog(self._spark, self._sf_dir, self._n, (part, parts))

    def _table(self, name: str) -> DataFrame:
        rows, (part, parts) = table(self._spark, self._sf_dir, name), self._part
        key = {"orders": "o_orderkey", "lineitem": "l_orderkey"}.get(name)
        return rows.where(in_part(key, part, parts)) if key and parts > 1 else rows

    @cached_property
    def _nation(self) -> DataFrame:
        return self._table("nation").select("n_nationkey", F.expr(_SCHEMA_NAME).alias("table_schema"))

    @cached_property
    def _base(self) -> DataFrame:
        """Orders with their place."""
        orders, customer = self._table("orders"), self._table("customer").select("c_custkey", "c_nationkey")
        return (
            orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
            .join(self._nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _connection(F.col("c_custkey"), self._n).alias("connection_qn"),
                "table_schema",
                F.expr("concat('t', o_orderkey, if(o_orderpriority = '5-LOW', '_TMP', ''))").alias("table_name"),
                *orders.columns,
            )
        )

    @cached_property
    def _places(self) -> DataFrame:
        return self._base.select("o_orderkey", *_PLACE)

    @cached_property
    def connections(self) -> DataFrame:
        numbers = self._spark.range(1, self._n + 1)
        return numbers.select(F.concat(F.lit(CONNECTION_PREFIX), F.col("id").cast("string")).alias("connection_qn"))

    @cached_property
    def schemata(self) -> DataFrame:
        each = F.explode(F.sequence(F.lit(1), F.lit(self._n))).alias("n")
        return _shaped(
            self._nation.select("table_schema", each),
            "schemata",
            connection_qn=F.concat(F.lit(CONNECTION_PREFIX), F.col("n").cast("string")),
            schema_name="table_schema",
        )

    @cached_property
    def tables(self) -> DataFrame:
        return _shaped(self._base, "tables", **_TABLE_VALUES)

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items with their place."""
        return self._table("lineitem").select("l_orderkey", "l_linenumber").join(self._places, on_order())

    @cached_property
    def columns(self) -> DataFrame:
        return _shaped(self._lines, "columns", **_COLUMN_VALUES)

    def dealt(self, relation: str, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A relation whose rows `deal` moves: before most values are made of what a row has, as a made row is several times longer."""
        if relation == "tables":
            return _shaped(deal(self._base), relation, **_TABLE_VALUES)
        if relation == "columns":
            return _shaped(deal(self._lines), relation, **_COLUMN_VALUES)
        return deal(getattr(self, relation))

    def stored(self, relation: str, rows: DataFrame) -> None:
        """Read a relation from where it was stored, also for those that are made of it."""
        self.__dict__[relation] = rows

    @cached_property
    def key_column_usage(self) -> DataFrame:
        pairs = self._table("lineitem").where("l_linenumber <= 3").select("l_orderkey", "l_linenumber").distinct()
        return _shaped(
            pairs.join(self._places, on_order()).select("*", F.explode(F.expr(_CONSTRAINT_NAMES)).alias("constraint_name")),
            "key_column_usage",
            constraint_schema="table_schema",
            column_name="concat('c', l_linenumber)",
        )

    @cached_property
    def table_constraints(self) -> DataFrame:
        return _shaped(
            self.key_column_usage.drop("column_name").distinct(),
            "table_constraints",
            constraint_type="""case when constraint_name = 'PRIMARY' then 'PRIMARY KEY'
                when constraint_name = 'uk_3' then 'UNIQUE' else 'FOREIGN KEY' end""",
        )

    @cached_property
    def partitions(self) -> DataFrame:
        lines = self._table("lineitem").select("l_orderkey", "l_suppkey")
        return _shaped(
            lines.join(self._places.where("o_orderkey % 10 = 0"), on_order()),
            "partitions",
            partition_method="'RANGE'",
            partition_name="concat('p', l_suppkey % 10)",
        ).unionByName(_shaped(self._places.where("o_orderkey % 10 <> 0"), "partitions"))

    @cached_property
    def views(self) -> DataFrame:
        return _shaped(
            self._base.where("o_orderstatus = 'O'"),
            "views",
            view_definition="""case o_orderkey % 5 when 0 then '' when 1 then null
                else concat('select c1 from t', o_custkey) end""",
        )

    @cached_property
    def routines(self) -> DataFrame:
        documents = self._table("documents").withColumn("h", F.expr("doc_id div 2"))
        return _shaped(
            documents.join(self._nation, F.col("h") % 25 == F.col("n_nationkey")),
            "routines",
            connection_qn=_connection(F.col("h"), self._n),
            routine_schema="table_schema",
            routine_name="if(doc_id % 20 in (0, 1), concat('pair_', h), concat('r', doc_id))",
            definer="source",
            routine_definition="if(doc_id % 11 = 0, null, text)",
            routine_type="if(doc_id % 2 = 1, 'FUNCTION', 'PROCEDURE')",
            routine_comment="lang",
            created="if(doc_id % 5 = 0, null, timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(0, doc_id))",
            last_altered="if(doc_id % 3 = 0, timestamp_ntz '1970-01-01 00:00:00', timestamp_ntz '2021-06-01 00:00:00')",
        )
