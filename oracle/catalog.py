"""DuckDB SQL for the catalog queries: the derived source relations as CTEs, then one statement per query.

Written independently of the Spark operators: set membership instead of one aggregate for key roles, window and
set operations instead of two-level aggregates for partitions and snapshots.
"""

from __future__ import annotations

# Fixed value: the key consumers read.
SCHEMA_REF = "atlanSchema"

CONNECTIONS = 3


def _conn(key: str) -> str:
    return f"'default/mysql/' || ({key} % {CONNECTIONS} + 1)"


# ---- source relations ---------------------------------------------------------------------------------------

_KIND = "(l_orderkey + l_linenumber) % 6"

RELATIONS = f"""
nations AS (SELECT n_nationkey, CASE n_nationkey WHEN 0 THEN 'mysql' WHEN 1 THEN 'performance_schema'
    WHEN 2 THEN 'information_schema' WHEN 3 THEN 'sys' ELSE n_name END AS table_schema FROM nation),
conns AS (SELECT 'default/mysql/' || n AS connection_qn FROM range(1, {CONNECTIONS} + 1) t(n)),
schemata AS (SELECT connection_qn, table_schema AS schema_name FROM conns, nations),
base AS (SELECT {_conn('c_custkey')} AS connection_qn, table_schema,
    't' || o_orderkey || CASE WHEN o_orderpriority = '5-LOW' THEN '_TMP' ELSE '' END AS table_name, orders.*
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey),
src_tables AS (SELECT connection_qn, table_schema, table_name,
    CASE o_orderstatus WHEN 'F' THEN 'BASE TABLE' WHEN 'O' THEN 'VIEW'
      ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'SYSTEM VERSIONED' ELSE 'SYSTEM VIEW' END END AS table_type,
    CASE WHEN o_orderstatus <> 'O' THEN 'InnoDB' END AS engine,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(10 AS BIGINT) END AS version,
    CASE WHEN o_orderstatus <> 'O' THEN 'Dynamic' END AS row_format,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(floor(o_totalprice) AS BIGINT) END AS table_rows,
    CASE WHEN o_orderstatus <> 'O' THEN o_custkey * 1024 END AS data_length,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 16 END AS index_length,
    CASE WHEN o_orderstatus = 'F' THEN o_orderkey + 1 END AS auto_increment,
    o_orderdate AS create_time,
    CASE WHEN o_orderstatus <> 'O' THEN 'utf8mb4_0900_ai_ci' END AS table_collation,
    CASE WHEN o_orderkey % 10 = 0 THEN 'partitioned' ELSE '' END AS create_options,
    CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE o_orderpriority END AS table_comment
    FROM base),
src_columns AS (SELECT connection_qn, table_schema, table_name, 'c' || l_linenumber AS column_name,
    CAST(l_linenumber AS BIGINT) AS ordinal_position,
    CASE WHEN l_linenumber = 4 THEN '0' END AS column_default,
    CASE WHEN l_linenumber <= 2 THEN 'NO' ELSE 'YES' END AS is_nullable,
    CASE {_KIND} WHEN 0 THEN 'int' WHEN 1 THEN 'varchar' WHEN 2 THEN 'decimal' WHEN 3 THEN 'timestamp'
      WHEN 4 THEN 'enum' ELSE 'json' END AS data_type,
    CAST(CASE {_KIND} WHEN 1 THEN 100 WHEN 4 THEN 20 END AS BIGINT) AS char_length,
    CAST(CASE {_KIND} WHEN 1 THEN 400 WHEN 4 THEN 80 END AS BIGINT) AS octet_length,
    CAST(CASE {_KIND} WHEN 0 THEN 10 WHEN 2 THEN 12 END AS BIGINT) AS num_precision,
    CAST(CASE {_KIND} WHEN 0 THEN 0 WHEN 2 THEN 2 END AS BIGINT) AS num_scale,
    CASE WHEN {_KIND} IN (1, 4) THEN 'utf8mb4' END AS charset,
    CASE WHEN {_KIND} IN (1, 4) THEN 'utf8mb4_0900_ai_ci' END AS collation_name,
    CASE {_KIND} WHEN 0 THEN 'int' WHEN 1 THEN 'varchar(100)' WHEN 2 THEN 'decimal(12,2)' WHEN 3 THEN 'timestamp'
      WHEN 4 THEN 'enum(a,b)' ELSE 'json' END AS column_type,
    CASE WHEN l_linenumber = 1 THEN 'PRI' WHEN l_linenumber = 2 AND l_orderkey % 3 = 0 THEN 'MUL'
      WHEN l_linenumber = 3 THEN 'UNI' ELSE '' END AS column_key,
    CASE WHEN l_linenumber = 1 THEN 'auto_increment' ELSE '' END AS extra,
    CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'line ' || l_linenumber END AS column_comment,
    CASE l_linenumber WHEN 6 THEN NULL WHEN 7 THEN 'c1 + 1' ELSE '' END AS generation_expression
    FROM lineitem JOIN base ON l_orderkey = o_orderkey),
src_partitions AS (
    SELECT connection_qn, table_schema, table_name, 'RANGE' AS method, 'p' || (l_suppkey % 10) AS name
    FROM base JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 10 = 0
    UNION ALL SELECT connection_qn, table_schema, table_name, NULL, NULL FROM base WHERE o_orderkey % 10 <> 0),
src_views AS (SELECT connection_qn, table_schema, table_name,
    CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'select c1 from t' || o_custkey END AS view_definition
    FROM base WHERE o_orderstatus = 'O'),
line_pairs AS (SELECT DISTINCT connection_qn, table_schema, table_name, l_orderkey, l_linenumber,
    'c' || l_linenumber AS column_name FROM lineitem JOIN base ON l_orderkey = o_orderkey),
key_usage AS (
    SELECT connection_qn, table_schema, table_name, column_name, 'PRIMARY' AS name, 'PRIMARY KEY' AS kind
      FROM line_pairs WHERE l_linenumber = 1
    UNION ALL SELECT connection_qn, table_schema, table_name, column_name, 'fk_' || l_linenumber, 'FOREIGN KEY'
      FROM line_pairs WHERE l_linenumber <= 2 AND l_orderkey % 3 = 0
    UNION ALL SELECT connection_qn, table_schema, table_name, column_name, 'uk_3', 'UNIQUE'
      FROM line_pairs WHERE l_linenumber = 3),
src_routines AS (SELECT {_conn('(doc_id // 2)')} AS connection_qn, table_schema AS routine_schema,
    CASE WHEN doc_id % 20 IN (0, 1) THEN 'pair_' || (doc_id // 2) ELSE 'r' || doc_id END AS routine_name,
    source AS definer, CASE WHEN doc_id % 11 <> 0 THEN text END AS routine_definition,
    CASE WHEN doc_id % 2 = 1 THEN 'FUNCTION' ELSE 'PROCEDURE' END AS routine_type, lang AS routine_comment,
    CASE WHEN doc_id % 5 <> 0 THEN TIMESTAMP '2020-01-01' + to_hours(doc_id) END AS created,
    CASE WHEN doc_id % 3 = 0 THEN TIMESTAMP '1970-01-01' ELSE TIMESTAMP '2021-06-01' END AS last_altered
    FROM documents JOIN nations ON (doc_id // 2) % 25 = n_nationkey)"""

_USER_SCHEMA = "{c} NOT IN ('mysql', 'performance_schema', 'information_schema', 'sys')"
_KEPT = "table_type IN ('BASE TABLE', 'SYSTEM VERSIONED', 'VIEW')"


def _rules(schema: str, include: str | None = None, exclude: str | None = None) -> str:
    text = _USER_SCHEMA.format(c=schema)
    if include:
        text += f" AND regexp_matches('def.' || {schema}, '{include}', 'i')"
    if exclude:
        text += f" AND NOT regexp_matches('def.' || {schema}, '{exclude}', 'i')"
    return text


def kept_tables(include: str | None = None, exclude: str | None = None, temp: str | None = None) -> str:
    text = f"kept AS (SELECT * FROM src_tables WHERE {_KEPT} AND {_rules('table_schema', include, exclude)}"
    return text + (f" AND NOT regexp_matches(table_name, '{temp}', 'i'))" if temp else ")")


KEPT = kept_tables()

# ---- extracts -----------------------------------------------------------------------------------------------

DATABASES = f"""
databases AS (SELECT connection_qn, 'def' AS database_name, 'def' AS datname, count(schema_name) AS schema_count
    FROM conns LEFT JOIN (SELECT * FROM schemata WHERE {_rules('schema_name')}) USING (connection_qn) GROUP BY 1)"""

SCHEMAS = f"""
schemas AS (SELECT connection_qn, 'def' AS catalog_name, schema_name, 'mysql' AS schema_owner,
      count(*) FILTER (table_type IN ('BASE TABLE', 'SYSTEM VERSIONED')) AS table_count,
      count(*) FILTER (table_type = 'VIEW') AS views_count
    FROM (SELECT s.connection_qn, s.schema_name, t.table_type FROM schemata s LEFT JOIN src_tables t
      ON t.connection_qn = s.connection_qn AND t.table_schema = s.schema_name)
    WHERE {_rules('schema_name')} GROUP BY connection_qn, schema_name)"""

PARTITION_SUMMARY = f"""
partition_summary AS (SELECT connection_qn, table_schema, table_name, method AS partition_method,
      count(*) AS partition_count, string_agg(name, ',' ORDER BY name) AS partitions
    FROM src_partitions WHERE {_rules('table_schema')} GROUP BY ALL)"""

TABLES = f"""{PARTITION_SUMMARY},
tables AS (SELECT t.connection_qn, 'def' AS table_catalog, t.table_schema, t.table_name,
      COALESCE(table_rows, 0) AS row_count, COALESCE(n_columns, 0) AS column_count,
      table_type AS table_kind, table_type, p.partition_method IS NOT NULL AS is_partition,
      p.partition_method AS partition_strategy,
      CASE WHEN p.partition_method IS NULL THEN 0 ELSE p.partition_count END AS partition_count,
      t.table_name AS parent_table_name, CAST(NULL AS VARCHAR) AS partitioned_parent_table,
      CAST(NULL AS VARCHAR) AS partition_constraint, 0 AS number_columns_in_part_key,
      CAST(NULL AS VARCHAR) AS columns_participating_in_part_key, view_definition,
      CAST(NULL AS VARCHAR) AS self_referencing_column_name, CAST(NULL AS VARCHAR) AS reference_generation,
      CAST(NULL AS VARCHAR) AS user_defined_type_catalog, CAST(NULL AS VARCHAR) AS user_defined_type_schema,
      CAST(NULL AS VARCHAR) AS user_defined_type_name,
      CASE WHEN table_type = 'VIEW' THEN 'YES' ELSE 'NO' END AS is_insertable_into, 'NO' AS is_typed,
      CAST(NULL AS VARCHAR) AS commit_action, table_comment AS remarks,
      COALESCE(data_length + index_length, 0) AS size_bytes, CAST(NULL AS VARCHAR) AS location,
      CAST(NULL AS VARCHAR) AS file_format_type, CAST(NULL AS VARCHAR) AS stage_region, engine,
      CAST(NULL AS VARCHAR) AS ref_generation, version, row_format, data_length, auto_increment, table_collation,
      create_options, create_time, p.partitions
    FROM kept t
    LEFT JOIN (SELECT connection_qn, table_schema, table_name, count(*) AS n_columns FROM src_columns GROUP BY ALL) c
      USING (connection_qn, table_schema, table_name)
    LEFT JOIN partition_summary p USING (connection_qn, table_schema, table_name)
    LEFT JOIN src_views v USING (connection_qn, table_schema, table_name))"""

COLUMNS = """
pk AS (SELECT DISTINCT connection_qn, table_schema, table_name, column_name, name FROM key_usage
    WHERE kind = 'PRIMARY KEY'),
fk AS (SELECT DISTINCT connection_qn, table_schema, table_name, column_name FROM key_usage
    WHERE kind = 'FOREIGN KEY'),
columns AS (SELECT DISTINCT c.connection_qn, 'def' AS table_catalog, c.table_schema, c.table_name, c.column_name,
      ordinal_position, column_default AS column_def, is_nullable, data_type,
      CASE WHEN contains(extra, 'auto_increment') THEN 'YES' ELSE 'NO' END AS is_auto_increment,
      num_precision AS numeric_precision, octet_length AS character_octet_length, octet_length AS buffer_length,
      CASE WHEN generation_expression IS NULL THEN 'NO' ELSE 'YES' END AS is_generated,
      CASE WHEN COALESCE(generation_expression, '') = '' THEN 'NO' ELSE 'YES' END AS is_generatedcolumn,
      'NO' AS is_identity, CAST(NULL AS VARCHAR) AS identity_cycle,
      COALESCE(char_length, num_precision) AS column_size, num_scale AS num_prec_radix,
      num_scale AS decimal_digits, t.table_type, 'NO' AS belongs_to_partition, 'NO' AS partitioned_table,
      CASE WHEN pk.column_name IS NOT NULL THEN 'PRIMARY KEY' WHEN fk.column_name IS NOT NULL THEN 'FOREIGN KEY'
        END AS constraint_type,
      pk.name AS constraint_name, column_comment AS remarks, CAST(NULL AS VARCHAR) AS partition_order,
      CAST(NULL AS VARCHAR) AS is_partition, num_scale AS numeric_scale, COALESCE(char_length, 0) AS max_length,
      CAST(NULL AS VARCHAR) AS is_self_referencing, extra AS extra_info, charset AS character_set_name,
      collation_name, column_type, column_key, 'select,insert,update,references' AS privileges,
      generation_expression, CASE WHEN contains(extra, 'auto_increment') THEN 'YES' ELSE 'NO' END AS is_autoincrement
    FROM src_columns c JOIN kept t USING (connection_qn, table_schema, table_name)
    LEFT JOIN pk USING (connection_qn, table_schema, table_name, column_name)
    LEFT JOIN fk USING (connection_qn, table_schema, table_name, column_name))"""

ROUTINES = f"""
routines AS (SELECT connection_qn, 'def' AS procedure_catalog, routine_schema AS procedure_schema,
      routine_name AS procedure_name, definer AS source_owner, routine_definition AS procedure_definition,
      routine_type AS procedure_type, routine_comment AS remarks, created, last_altered
    FROM src_routines WHERE {_rules('routine_schema')})"""

# ---- entities, flattened ------------------------------------------------------------------------------------


def _shared(qualified_name: str, name: str) -> str:
    return f"""'ACTIVE' AS status, {name} AS name, {qualified_name} AS "qualifiedName",
      connection_qn AS "connectionQualifiedName", 'mysql' AS "connectorName",
      CAST(NULL AS VARCHAR) AS "connectionName", 'default' AS "tenantId" """


def _place(schema: str) -> str:
    return f"""'def' AS "databaseName", connection_qn || '/def' AS "databaseQualifiedName", {schema} AS "schemaName",
      connection_qn || '/def/' || {schema} AS "schemaQualifiedName" """


def _schema_ref(schema: str) -> str:
    return f"""'Schema' AS "{SCHEMA_REF}TypeName", connection_qn || '/def/' || {schema} AS "{SCHEMA_REF}QualifiedName" """


_TABLE_QN = "connection_qn || '/def/' || table_schema || '/' || table_name"

E_DATABASE = f"""{DATABASES},
e_database AS (SELECT connection_qn, 'Database' AS "typeName",
      {_shared("connection_qn || '/' || database_name", 'database_name')},
      schema_count AS "schemaCount" FROM databases)"""

E_SCHEMA = f"""{SCHEMAS},
e_schema AS (SELECT connection_qn, 'Schema' AS "typeName",
      {_shared("connection_qn || '/def/' || schema_name", 'schema_name')},
      'def' AS "databaseName", connection_qn || '/def' AS "databaseQualifiedName", table_count AS "tableCount",
      views_count AS "viewsCount", 'Database' AS "databaseTypeName",
      connection_qn || '/def' AS "databaseRefQualifiedName" FROM schemas)"""

E_TABLE = f"""{KEPT}, {TABLES},
e_table AS (SELECT connection_qn, CASE WHEN is_view THEN 'View' ELSE 'Table' END AS "typeName",
      {_shared(_TABLE_QN, 'table_name')}, {_place('table_schema')},
      COALESCE(remarks, '') AS description, column_count AS "columnCount", size_bytes AS "sizeBytes",
      CASE WHEN NOT is_view THEN row_count END AS "rowCount", CASE WHEN NOT is_view THEN 'TABLE' END AS "subType",
      CASE WHEN NOT is_view THEN is_partition END AS "isPartitioned",
      CASE WHEN NOT is_view THEN partition_count END AS "partitionCount",
      CASE WHEN is_view THEN CASE WHEN COALESCE(view_definition, '') = '' THEN ''
        ELSE 'CREATE OR REPLACE VIEW ' || table_name || ' AS ' || view_definition END END AS definition,
      nullif(epoch_ms(create_time), 0) AS "sourceCreatedAt", {_schema_ref('table_schema')},
      CASE WHEN is_view THEN 'def' END AS "defaultCatalogName",
      CASE WHEN is_view THEN table_schema END AS "defaultSchemaName",
      COALESCE(engine, '') AS custom_engine, COALESCE(CAST(version AS VARCHAR), '') AS custom_version,
      COALESCE(row_format, '') AS custom_row_format, COALESCE(CAST(data_length AS VARCHAR), '') AS custom_data_length,
      COALESCE(table_collation, '') AS custom_table_collation, COALESCE(create_options, '') AS custom_create_options,
      '' AS custom_is_transient
    FROM (SELECT *, table_kind = 'VIEW' AS is_view FROM tables))"""

_CUSTOM_TEXT = (
    "is_self_referencing", "is_auto_increment", "is_generated", "extra_info", "character_set_name",
    "collation_name", "column_type", "column_key", "privileges", "generation_expression", "is_autoincrement",
    "is_generatedcolumn", "constraint_type", "constraint_name", "is_identity", "identity_cycle",
)
_CUSTOM_NUMBER = ("ordinal_position", "numeric_precision", "buffer_length", "column_size", "character_octet_length")

E_COLUMN = f"""{KEPT}, {COLUMNS},
e_column AS (SELECT connection_qn, 'Column' AS "typeName", {_shared(_TABLE_QN + " || '/' || column_name", 'column_name')},
      {_place('table_schema')},
      CASE WHEN NOT is_view THEN table_name END AS "tableName", CASE WHEN NOT is_view THEN {_TABLE_QN} END AS "tableQualifiedName",
      CASE WHEN is_view THEN table_name END AS "viewName", CASE WHEN is_view THEN {_TABLE_QN} END AS "viewQualifiedName",
      upper(data_type) AS "dataType", COALESCE(remarks, '') AS description, is_nullable = 'YES' AS "isNullable",
      FALSE AS "isPartition", COALESCE(constraint_type = 'PRIMARY KEY', FALSE) AS "isPrimary",
      COALESCE(constraint_type = 'FOREIGN KEY', FALSE) AS "isForeign", max_length AS "maxLength",
      COALESCE(numeric_scale, 0) AS "numericScale", COALESCE(numeric_precision, 0) AS precision,
      ordinal_position AS "order",
      CASE WHEN NOT is_view THEN 'Table' END AS "tableTypeName", CASE WHEN NOT is_view THEN {_TABLE_QN} END AS "tableRefQualifiedName",
      CASE WHEN is_view THEN 'View' END AS "viewTypeName", CASE WHEN is_view THEN {_TABLE_QN} END AS "viewRefQualifiedName",
      {", ".join(f"COALESCE({k}, '') AS custom_{k}" for k in _CUSTOM_TEXT)},
      {", ".join(f"{k} AS custom_{k}" for k in _CUSTOM_NUMBER)}, data_type AS custom_type_name
    FROM (SELECT *, table_type = 'VIEW' AS is_view FROM columns))"""

E_PROCEDURE = f"""{ROUTINES},
e_procedure AS (SELECT connection_qn, 'Procedure' AS "typeName",
      {_shared("connection_qn || '/def/' || procedure_schema || '/_procedures_/' || procedure_name", 'procedure_name')},
      {_place('procedure_schema')},
      COALESCE(procedure_definition, '') AS definition, procedure_type AS "subType",
      COALESCE(remarks, '') AS description, nullif(source_owner, '') AS "sourceCreatedBy",
      nullif(epoch_ms(created), 0) AS "sourceCreatedAt", nullif(epoch_ms(last_altered), 0) AS "sourceUpdatedAt",
      {_schema_ref('procedure_schema')} FROM routines)"""


def _json_members(*members: str) -> str:
    """A JSON object of the members that are not NULL."""
    return "'{' || concat_ws(',', " + ", ".join(members) + ") || '}'"


def _member(key: str, column: str | None = None) -> str:
    column = column or f'"{key}"'
    return f"""'"{key}":' || CAST(to_json({column}) AS VARCHAR)"""


def _ref_member(key: str, qualified_name: str) -> str:
    unique = _json_members(_member("qualifiedName", f'"{qualified_name}"'))
    return f"""CASE WHEN "{key}TypeName" IS NOT NULL THEN '"{key}":' || """ + (
        _json_members(_member("typeName", f'"{key}TypeName"'), f"""'"uniqueAttributes":' || {unique}""") + " END"
    )


_SHARED_NAMES = "name qualifiedName connectionQualifiedName connectorName connectionName tenantId"
_PLACE_NAMES = "databaseName databaseQualifiedName schemaName schemaQualifiedName"


def _json_line(stream: str, attributes: str, refs: dict[str, str], defaults: bool = False, custom: str = "") -> str:
    inner = [_member(a) for a in f"{_SHARED_NAMES} {attributes}".split()]
    inner += [_ref_member(key, qualified_name) for key, qualified_name in refs.items()]
    members = [_member("typeName"), _member("status"), f"""'"attributes":' || {_json_members(*inner)}"""]
    if defaults:
        members += [_member("defaultCatalogName"), _member("defaultSchemaName")]
    if custom:
        members.append(f"""'"customAttributes":' || {custom}""")
    return f"SELECT '{stream}' AS stream, {_json_members(*members)} AS value FROM e_{stream}"


def _custom_member(key: str) -> str:
    unknown = {"ordinal_position": "null", "numeric_precision": "null", "column_size": "null"}.get(key, '""')
    return f"""'"{key}":' || COALESCE(CAST(to_json(custom_{key}) AS VARCHAR), '{unknown}')"""


_TABLE_CUSTOM = "engine version row_format data_length table_collation create_options is_transient"
_COLUMN_CUSTOM = (
    "ordinal_position is_self_referencing numeric_precision is_auto_increment is_generated extra_info "
    "character_set_name collation_name column_type column_key privileges generation_expression is_autoincrement "
    "is_generatedcolumn constraint_type constraint_name buffer_length column_size is_identity identity_cycle "
    "character_octet_length type_name"
)

JSON_LINES = "\nUNION ALL ".join(
    (
        _json_line("database", "schemaCount", {}),
        _json_line("schema", "databaseName databaseQualifiedName tableCount viewsCount", {"database": "databaseRefQualifiedName"}),
        _json_line(
            "table",
            f"{_PLACE_NAMES} description columnCount sizeBytes rowCount subType isPartitioned partitionCount "
            "definition sourceCreatedAt",
            {SCHEMA_REF: f"{SCHEMA_REF}QualifiedName"},
            defaults=True,
            custom=_json_members(*map(_custom_member, _TABLE_CUSTOM.split())),
        ),
        _json_line(
            "column",
            f"{_PLACE_NAMES} tableName tableQualifiedName viewName viewQualifiedName dataType description "
            "isNullable isPartition isPrimary isForeign maxLength numericScale precision order",
            {"table": "tableRefQualifiedName", "view": "viewRefQualifiedName"},
            custom=_json_members(*map(_custom_member, _COLUMN_CUSTOM.split())),
        ),
        _json_line(
            "procedure",
            f"{_PLACE_NAMES} definition subType description sourceCreatedBy sourceCreatedAt sourceUpdatedAt",
            {SCHEMA_REF: f"{SCHEMA_REF}QualifiedName"},
        ),
    )
)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join((RELATIONS, *parts)) + "\n"


_ALL_ENTITIES = ", ".join((E_DATABASE, E_SCHEMA, E_TABLE, E_COLUMN.replace(f"{KEPT}, ", "", 1), E_PROCEDURE))

_FEED = _with(E_TABLE, E_PROCEDURE) + """
SELECT connection_qn, "typeName" AS type_name, "qualifiedName" AS qualified_name, definition AS sql,
  "databaseName" AS catalog, "schemaName" AS schema, 'mysql' AS vendor,
  "defaultCatalogName" AS default_catalog, "defaultSchemaName" AS default_schema
FROM e_table WHERE "typeName" = 'View' AND definition <> ''
UNION ALL
SELECT connection_qn, "typeName", "qualifiedName", definition, "databaseName", "schemaName", 'mysql', NULL, NULL
FROM e_procedure WHERE definition <> ''"""

_REQUIRED = {
    "e_database": ("Database", "name qualifiedName connectionQualifiedName connectorName schemaCount tenantId"),
    "e_schema": ("Schema", "name qualifiedName connectionQualifiedName connectorName databaseName "
                 "databaseQualifiedName tableCount viewsCount tenantId"),
    "t_table": ("Table", "name qualifiedName connectionQualifiedName connectorName databaseName "
                "databaseQualifiedName schemaName schemaQualifiedName description columnCount sizeBytes "
                "isPartitioned partitionCount tenantId"),
    "t_view": ("View", "name qualifiedName connectionQualifiedName connectorName databaseName "
               "databaseQualifiedName schemaName schemaQualifiedName definition description columnCount sizeBytes "
               "tenantId"),
    "e_column": ("Column", "name qualifiedName connectionQualifiedName connectorName databaseName "
                 "databaseQualifiedName schemaName schemaQualifiedName description dataType isNullable isPartition "
                 "isPrimary isForeign maxLength numericScale order precision tenantId"),
}

# The defects the Spark side seeds: no description on 'InnoDB'-less objects, no type on json columns, no owner schema.
_DEFECT_TABLE = """t_all AS (SELECT * REPLACE (CASE WHEN custom_engine <> '' THEN description END AS description)
    FROM e_table), t_table AS (SELECT * FROM t_all WHERE "typeName" = 'Table'),
    t_view AS (SELECT * FROM t_all WHERE "typeName" = 'View')"""
_DEFECT_COLUMN = """d_column AS (SELECT * REPLACE (CASE WHEN "dataType" <> 'JSON' THEN "dataType" END AS "dataType")
    FROM e_column)"""


def _missing() -> str:
    selects = []
    for source, (type_name, names) in _REQUIRED.items():
        source = "d_column" if source == "e_column" else source
        selects += [
            f"""SELECT '{type_name}' AS "typeName", '{n}' AS attribute, count(*) - count("{n}") AS missing FROM {source}"""
            for n in names.split()
        ]
    return _with(_ALL_ENTITIES, _DEFECT_TABLE, _DEFECT_COLUMN) + "\nUNION ALL ".join(selects)


def _diff(old: str, new: str, entity: str, *values: str) -> str:
    """Snapshot diff by set difference of contents per key."""
    content = ", ".join(values)
    keys = 'connection_qn, "typeName", "qualifiedName"'
    return f"""old_s AS (SELECT {keys}, {content} FROM ({old})), new_s AS (SELECT {keys}, {content} FROM ({new})),
    changed AS ((SELECT {keys} FROM (SELECT * FROM old_s EXCEPT SELECT * FROM new_s))
      UNION (SELECT {keys} FROM (SELECT * FROM new_s EXCEPT SELECT * FROM old_s))),
    diff AS (SELECT {keys}, CASE
        WHEN ({keys}) NOT IN (SELECT ({keys}) FROM old_s) THEN 'insert'
        WHEN ({keys}) NOT IN (SELECT ({keys}) FROM new_s) THEN 'archive'
        WHEN ({keys}) IN (SELECT ({keys}) FROM changed) THEN 'update' ELSE 'unchanged' END AS change
      FROM (SELECT {keys} FROM old_s UNION SELECT {keys} FROM new_s)
      WHERE connection_qn IN (SELECT connection_qn FROM new_s))"""


_DAY_MS = "epoch_ms(TIMESTAMP '1998-01-01')"
TABLE_DIFF = _diff(
    f'SELECT * FROM e_table WHERE "sourceCreatedAt" < {_DAY_MS}',
    """SELECT * REPLACE (CASE WHEN description = '2-HIGH' THEN "rowCount" + 1 ELSE "rowCount" END AS "rowCount")
       FROM e_table WHERE description <> '1-URGENT' AND connection_qn <> 'default/mysql/3'""",
    "e_table", '"rowCount"', "description",
)
PROCEDURE_DIFF = _diff(
    "SELECT * FROM e_procedure",
    """SELECT * FROM e_procedure WHERE NOT ("subType" = 'FUNCTION' AND description = 'fr')""",
    "e_procedure", '"subType"', "definition",
)

# Two runs over tables and procedures; of connection 3 the second run has procedures, so its tables are gone.
_ROW = 'connection_qn, "typeName", "qualifiedName"'
RUN_DIFF = _diff(
    f"""SELECT {_ROW}, CAST("rowCount" AS VARCHAR) AS a, description AS b FROM e_table WHERE "sourceCreatedAt" < {_DAY_MS}
        UNION ALL SELECT {_ROW}, "subType", definition FROM e_procedure""",
    f"""SELECT {_ROW}, CAST(CASE WHEN description = '2-HIGH' THEN "rowCount" + 1 ELSE "rowCount" END AS VARCHAR) AS a, description AS b
        FROM e_table WHERE description <> '1-URGENT' AND connection_qn <> 'default/mysql/3'
        UNION ALL SELECT {_ROW}, "subType", definition FROM e_procedure WHERE NOT ("subType" = 'FUNCTION' AND description = 'fr')""",
    "e_table", "a", "b",
)

_WEAK = "CASE WHEN l_linenumber = 7 THEN 'NaN'::DOUBLE WHEN l_linenumber = 6 THEN 'Infinity'::DOUBLE " \
        "WHEN l_linenumber <> 5 THEN l_extendedprice END"

SQL = {
    "database_inventory": _with(DATABASES) + "SELECT * FROM databases",
    "schema_inventory": _with(SCHEMAS) + "SELECT * FROM schemas",
    "schema_picker": _with() + f"""SELECT connection_qn, 'def' AS catalog_name, schema_name FROM schemata
        WHERE {_rules('schema_name')} AND NOT regexp_matches(schema_name,
          '^performance_schema$|^information_schema.*|^mysql$|^sys$|^METRICS_SCHEMA.*', 'i')""",
    "schema_picker_hidden": _with() + f"""SELECT connection_qn, 'def' AS catalog_name, schema_name FROM schemata
        WHERE {_rules('schema_name')} AND schema_name NOT IN ('NATION_3', 'NATION_4')""",
    "accessible_table_count": _with(kept_tables(temp="_TMP")) + """SELECT connection_qn, count(table_name) AS count
        FROM conns LEFT JOIN kept USING (connection_qn) GROUP BY 1""",
    "tables_per_schema": _with() + f"""SELECT connection_qn, table_schema, count(*) AS table_count FROM src_tables
        WHERE {_rules('table_schema')} GROUP BY ALL""",
    "table_inventory": _with(KEPT, TABLES) + "SELECT * FROM tables",
    "partition_summary": _with(PARTITION_SUMMARY) + "SELECT * FROM partition_summary",
    "constraint_roles": _with() + """SELECT connection_qn, table_schema, table_name, column_name,
        CASE WHEN bool_or(kind = 'PRIMARY KEY') THEN 'PRIMARY KEY' ELSE 'FOREIGN KEY' END AS constraint_type,
        min(name) FILTER (kind = 'PRIMARY KEY') AS constraint_name
        FROM key_usage WHERE kind <> 'UNIQUE' GROUP BY ALL""",
    "column_inventory": _with(KEPT, COLUMNS) + "SELECT * FROM columns",
    "column_inventory_without_temp": _with(kept_tables(temp="_TMP$"), COLUMNS)
    + "SELECT connection_qn, table_schema, table_name, column_name, table_type, constraint_type FROM columns",
    "schema_order": _with(SCHEMAS) + """SELECT connection_qn, schema_name,
        row_number() OVER (ORDER BY connection_qn, schema_name) AS position FROM schemas""",
    "column_order": _with(KEPT, COLUMNS) + """SELECT connection_qn, table_schema, table_name, ordinal_position,
        row_number() OVER (ORDER BY connection_qn, table_schema, table_name, ordinal_position) AS position FROM columns""",
    "routine_inventory": _with(ROUTINES) + "SELECT * FROM routines",
    "filter_include_exclude": _with(kept_tables(r"^def\.nation_1", r"^def\.NATION_12$"))
    + "SELECT connection_qn, table_schema, table_name, table_type FROM kept",
    "filter_current_database": _with(KEPT) + r"""SELECT connection_qn, table_schema, table_name, table_type FROM kept
        WHERE regexp_matches('shop.' || table_schema, '^shop\.NATION_1', 'i')""",
    "filter_temp_tables": _with(kept_tables(temp="_(tmp|scratch)$"))
    + "SELECT connection_qn, table_schema, table_name, table_type FROM kept",
    "filter_per_connection": _with(KEPT) + r"""SELECT connection_qn, table_schema, table_name, table_type FROM kept
        WHERE CASE connection_qn WHEN 'default/mysql/1' THEN regexp_matches('def.' || table_schema, '^def\.NATION_1', 'i')
            WHEN 'default/mysql/2' THEN NOT regexp_matches('def.' || table_schema, 'nation_2', 'i')
              AND NOT regexp_matches(table_name, '_tmp$', 'i') ELSE TRUE END""",
    "filter_map": _with(KEPT) + """SELECT connection_qn, table_schema, table_name, table_type FROM kept
        WHERE table_schema IN ('NATION_4', 'NATION_11') OR regexp_matches(table_schema, '^NATION_2[0-9]$')""",
    "entity_database": _with(E_DATABASE) + "SELECT * FROM e_database",
    "entity_schema": _with(E_SCHEMA) + "SELECT * FROM e_schema",
    "entity_table": _with(E_TABLE) + """SELECT * EXCLUDE (definition, "defaultCatalogName", "defaultSchemaName")
        FROM e_table WHERE "typeName" = 'Table'""",
    "entity_view": _with(E_TABLE) + """SELECT * EXCLUDE ("rowCount", "subType", "isPartitioned", "partitionCount")
        FROM e_table WHERE "typeName" = 'View'""",
    "entity_column": _with(E_COLUMN) + "SELECT * FROM e_column",
    "entity_procedure": _with(E_PROCEDURE) + "SELECT * FROM e_procedure",
    "entity_two_families": _with(E_TABLE) + """SELECT connection_qn, "typeName", "qualifiedName",
        CASE connection_qn WHEN 'default/mysql/3' THEN 'main' ELSE "databaseName" END AS "databaseName", "schemaName",
        CASE WHEN connection_qn <> 'default/mysql/3' THEN e.description WHEN table_comment IS NULL THEN 'NONE'
          ELSE upper(e.description) END AS description,
        CASE WHEN connection_qn = 'default/mysql/3' THEN s.table_collation END AS comparison,
        CASE WHEN connection_qn <> 'default/mysql/3' THEN custom_engine ELSE COALESCE(lower(s.engine), '-') END AS engine
        FROM e_table e JOIN (SELECT connection_qn, table_schema AS "schemaName", table_name AS name, engine, table_collation, table_comment
          FROM src_tables) s USING (connection_qn, "schemaName", name)
        WHERE connection_qn <> 'default/mysql/3' OR "schemaName" <> 'NATION_5'""",
    "entity_json": _with(_ALL_ENTITIES) + JSON_LINES,
    "jsonl_delivery": _with(_ALL_ENTITIES) + "\nUNION ALL ".join(
        f"SELECT '{stream}' AS stream, connection_qn AS connection_id, count(*) AS lines "
        f"FROM e_{stream} GROUP BY ALL" for stream in ("database", "schema", "table", "column", "procedure")
    ),
    "delivery_manifest": _with(_ALL_ENTITIES) + f"""SELECT stream, count(*) AS lines, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes
        FROM ({JSON_LINES}) GROUP BY stream""",
    "entity_json_fields": _with(_ALL_ENTITIES) + """
        SELECT 'database' AS stream, "typeName" AS type_name, "qualifiedName" AS qualified_name, NULL::VARCHAR AS detail FROM e_database
        UNION ALL SELECT 'schema', "typeName", "qualifiedName", CAST("tableCount" AS VARCHAR) FROM e_schema
        UNION ALL SELECT 'table', "typeName", "qualifiedName", custom_data_length FROM e_table
        UNION ALL SELECT 'column', "typeName", "qualifiedName", COALESCE(CAST(custom_buffer_length AS VARCHAR), '') FROM e_column
        UNION ALL SELECT 'procedure', "typeName", "qualifiedName", definition FROM e_procedure""",
    "lineage_parse_feed": _FEED,
    "lineage_parse_feed_json": _FEED,
    "orphan_columns": _with(KEPT) + f"""
        SELECT DISTINCT c.connection_qn, c.table_schema, c.table_name, c.column_name,
          CASE WHEN c.table_schema = 'NATION_7' THEN 'no_table' ELSE 'other_kind' END AS reason
        FROM src_columns c LEFT JOIN kept t USING (connection_qn, table_schema, table_name)
        WHERE {_rules('c.table_schema')} AND NOT regexp_matches(c.table_name, '_TMP$', 'i')
          AND (t.table_type IS NULL OR c.table_schema = 'NATION_7' OR c.table_schema = 'NATION_8' AND t.table_type = 'BASE TABLE')""",
    "qn_hierarchy_violations": _with(E_TABLE, COLUMNS) + f"""
        SELECT 'Column' AS "typeName", {_TABLE_QN} || '/' || column_name AS "qualifiedName",
          {_TABLE_QN} AS "parentQualifiedName", 'parent_missing' AS violation
        FROM columns WHERE regexp_matches(table_name, '_TMP', 'i')
        UNION ALL SELECT "typeName", "qualifiedName", 'default/mysql/x/def/' || "schemaName", 'not_below_parent'
        FROM e_table WHERE "schemaName" = 'NATION_7' AND NOT regexp_matches(name, '_TMP', 'i')""",
    "duplicate_qn": _with(E_PROCEDURE) + """SELECT "typeName", "qualifiedName", count(*) AS n FROM e_procedure
        GROUP BY ALL HAVING count(*) > 1""",
    "required_attributes": _missing(),
    "all_findings": _with(E_SCHEMA, E_TABLE, E_COLUMN.replace(f"{KEPT}, ", "", 1)) + """
        SELECT 'database' AS stream, 'unexpected_type' AS "check", "typeName", '' AS detail, count(*) AS n FROM e_schema GROUP BY ALL
        UNION ALL SELECT 'table', 'missing_attribute', "typeName", 'description', count(*) FROM e_table WHERE custom_engine = '' GROUP BY ALL
        UNION ALL SELECT 'table', 'bad_reference', "typeName", '', count(*) FROM e_table WHERE "schemaName" IN ('NATION_5', 'NATION_7') GROUP BY ALL
        UNION ALL SELECT 'table', 'wrong_constant', "typeName", '', count(*) FROM e_table WHERE connection_qn = 'default/mysql/2' GROUP BY ALL
        UNION ALL SELECT 'column', 'missing_attribute', 'Column', 'dataType', count(*) FROM e_column WHERE "dataType" = 'JSON' GROUP BY ALL""",
    "parent_conflicts": _with(E_COLUMN) + """SELECT "typeName", "qualifiedName" FROM e_column
        WHERE "order" = 5 AND "viewName" IS NULL OR "order" = 6 AND "tableName" IS NOT NULL""",
    "bad_references": _with(_ALL_ENTITIES) + """SELECT "typeName", "qualifiedName" FROM e_table
        WHERE "schemaName" IN ('NATION_5', 'NATION_6', 'NATION_7')
        UNION ALL SELECT "typeName", "qualifiedName" FROM e_column
        WHERE "tableName" IS NOT NULL AND "schemaName" IN ('NATION_5', 'NATION_6', 'NATION_7')
        UNION ALL SELECT "typeName", "qualifiedName" FROM e_procedure
        WHERE "schemaName" IN ('NATION_5', 'NATION_6', 'NATION_7')""",
    "wrong_constants": _with(E_TABLE, E_PROCEDURE) + """SELECT "typeName", "qualifiedName" FROM e_table
        WHERE connection_qn = 'default/mysql/2'
        UNION ALL SELECT "typeName", "qualifiedName" FROM e_procedure WHERE connection_qn = 'default/mysql/2'""",
    "invalid_json": _with(E_SCHEMA) + """SELECT "qualifiedName" AS qualified_name FROM e_schema
        WHERE "tableCount" > "viewsCount" """,
    "stream_type_check": _with(E_TABLE, E_PROCEDURE) + """
        SELECT 'column' AS stream, "typeName", count(*) AS n FROM e_table GROUP BY ALL
        UNION ALL SELECT 'table', 'Procedure', count(*) FROM e_procedure""",
    "entity_count_floors": _with(_ALL_ENTITIES) + """
        SELECT f."typeName", COALESCE(n, 0) AS n, CAST(floor AS BIGINT) AS floor, COALESCE(n, 0) >= floor AS ok
        FROM (VALUES ('Database', 3), ('Schema', 25), ('Table', 40), ('View', 7), ('Column', 500), ('Procedure', 1000000000),
          ('Index', 1)) f("typeName", floor)
        LEFT JOIN (SELECT "typeName", count(*) AS n FROM (
          SELECT "typeName" FROM e_database UNION ALL SELECT "typeName" FROM e_schema
          UNION ALL SELECT "typeName" FROM e_table UNION ALL SELECT "typeName" FROM e_column
          UNION ALL SELECT "typeName" FROM e_procedure) GROUP BY 1) c USING ("typeName")""",
    "snapshot_diff": _with(E_TABLE, TABLE_DIFF) + "SELECT * FROM diff",
    "snapshot_diff_shared_names": _with(E_PROCEDURE, PROCEDURE_DIFF) + "SELECT * FROM diff",
    "undelivered_connections": _with(E_TABLE, TABLE_DIFF) + """SELECT DISTINCT connection_qn FROM old_s
        WHERE connection_qn NOT IN (SELECT connection_qn FROM new_s)""",
    "incremental_changes": _with(E_TABLE, TABLE_DIFF)
    + "SELECT * FROM diff WHERE change IN ('insert', 'update', 'archive')",
    "changed_entities": _with(E_TABLE, TABLE_DIFF) + """SELECT new_s.* FROM new_s
        SEMI JOIN (SELECT * FROM diff WHERE change IN ('insert', 'update')) d
        USING (connection_qn, "typeName", "qualifiedName")""",
    "incremental_run": _with(E_TABLE, E_PROCEDURE, RUN_DIFF) + "SELECT * FROM diff WHERE change <> 'unchanged'",
    "incremental_entities": _with(E_TABLE, TABLE_DIFF) + """SELECT new_s.* FROM new_s
        SEMI JOIN (SELECT * FROM diff WHERE change IN ('insert', 'update')) d
        USING (connection_qn, "typeName", "qualifiedName")""",
    "scalar_epoch_ms": """SELECT o_orderkey, epoch_ms(o_orderdate) AS from_time,
        CASE WHEN o_orderpriority <> '5-LOW' THEN epoch_ms(o_orderdate) END AS from_text,
        CASE WHEN o_orderpriority <> '5-LOW' THEN epoch_ms(o_orderdate) END AS from_zoned_text,
        o_custkey AS from_number, CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS from_double,
        nullif(o_custkey, 0) AS set_only FROM orders""",
    "scalar_safe_str": f"""SELECT l_orderkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS whole,
        CASE WHEN l_tax = 0 THEN '0' ELSE CAST(l_tax AS VARCHAR) END AS fraction,
        CASE WHEN l_linenumber >= 5 THEN '' WHEN l_extendedprice = floor(l_extendedprice)
          THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) ELSE CAST(l_extendedprice AS VARCHAR) END AS weak,
        CAST(l_linenumber AS VARCHAR) AS number, l_returnflag AS text FROM lineitem""",
    "scalar_coerce_numeric": f"""SELECT l_orderkey, CASE WHEN l_linenumber >= 5 THEN 0 ELSE l_extendedprice END AS coerced,
        CASE WHEN l_linenumber < 5 THEN l_extendedprice END AS finite,
        CASE WHEN l_linenumber = 5 THEN 0 ELSE l_linenumber END AS whole FROM lineitem""",
    "region_from_host": """SELECT s_suppkey, CASE WHEN s_nationkey % 4 = 0 THEN NULL WHEN s_nationkey % 4 = 1 THEN NULL
        WHEN s_nationkey % 4 = 2 THEN NULL ELSE 'zone-' || s_nationkey || '-a' END AS region FROM supplier""",
    "error_causes": """WITH RECURSIVE err AS (SELECT event_id AS id,
          CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 2006 WHEN event_type = 'view' AND event_id % 40 = 0 THEN 1040
            WHEN event_type = 'click' AND event_id % 45 = 0 THEN 1045 END AS number,
          CASE WHEN event_id % 11 = 0 THEN event_id - 2 WHEN event_id % 97 <> 0 THEN event_id - 1
            WHEN event_id % 970 = 0 THEN event_id + 9 END AS next FROM events),
        walk AS (SELECT id, id AS here FROM err
          UNION SELECT w.id, e.next FROM walk w JOIN err e ON e.id = w.here WHERE e.number IS NULL AND e.next IS NOT NULL),
        found AS (SELECT w.id, CAST(max(e.number) AS BIGINT) AS errno FROM walk w LEFT JOIN err e ON e.id = w.here GROUP BY 1),
        classes AS (SELECT id AS error_id, errno, CASE WHEN id % 61 = 0 THEN 'timeout'
          WHEN errno IN (1040, 1203, 1226) THEN 'connection_limit' WHEN errno IN (1053, 2006, 2013) THEN 'server_restart'
          ELSE 'definitive' END AS error_class FROM found)
        SELECT *, error_class <> 'definitive' AS retryable FROM classes""",
    "error_class": """SELECT event_id, CASE WHEN event_type IN ('view', 'signup') THEN 'connection_limit'
        WHEN event_type = 'error' THEN 'server_restart' ELSE 'definitive' END AS error_class FROM events""",
    "settings_map": """SELECT user_id,
        COALESCE(string_agg(event_type || '=' || COALESCE(last, ''), chr(10) ORDER BY event_type) FILTER (NOT nested), '') AS settings,
        COALESCE(string_agg(event_type || '=' || COALESCE(last, ''), chr(10) ORDER BY event_type) FILTER (nested), '') AS extra
        FROM (SELECT user_id, event_type, value >= 20 AS nested, arg_max(props, event_id) AS last FROM events GROUP BY ALL)
        GROUP BY user_id""",
    "latest_settings": """SELECT user_id, CASE WHEN value >= 20 THEN 'extra' ELSE '' END AS section, event_type AS key,
        arg_max(props, event_id) AS value FROM events GROUP BY 1, 2, 3""",
}
# A stored catalog gives the rows of the one it was written from.
_STORED = ("schema_inventory", "table_inventory", "partition_summary", "constraint_roles", "column_inventory", "routine_inventory", "entity_column")
SQL |= {f"stored_{name}": SQL[name] for name in _STORED}
# So do extracts from text.
_TEXTS = {"database": "database_inventory", "schema": "schema_inventory", "table": "table_inventory", "column": "column_inventory", "procedure": "routine_inventory"}
SQL |= {f"text_{name}": SQL[operator] for name, operator in _TEXTS.items()}
SQL["text_with_rules"] = (
    _with(kept_tables(r"^def\.nation_1", r"^def\.NATION_12$", temp="_TMP$")) + "SELECT connection_qn, table_schema, table_name, table_type FROM kept"
)
SQL["entity_other_names"] = SQL["entity_column"]
