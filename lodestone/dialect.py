"""Everything that depends on the kind of source database, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# Names and kinds the source server uses, and the values the entities must carry.
SYSTEM_SCHEMAS = ("mysql", "performance_schema", "information_schema", "sys")
KEPT_TABLE_TYPES = ("BASE TABLE", "SYSTEM VERSIONED", "VIEW")
TABLE_COUNT_TYPES = ("BASE TABLE", "SYSTEM VERSIONED")
VIEW_COUNT_TYPE = "VIEW"
VIEW_KINDS = ("VIEW", "SYSTEM VIEW")
DEFAULT_CATALOG = "def"
SCHEMA_OWNER = "mysql"
VENDOR = "mysql"
PRIMARY_KEY = "PRIMARY KEY"
FOREIGN_KEY = "FOREIGN KEY"
PICKER_HIDDEN_SCHEMAS = ("^performance_schema$", "^information_schema.*", "^mysql$", "^sys$", "^METRICS_SCHEMA.*")
CONNECTION_LIMIT_ERRNOS = (1040, 1203, 1226)
SERVER_RESTART_ERRNOS = (1053, 2006, 2013)
RDS_REGION_PATTERN = r"\.([a-z0-9-]+)\.rds\.amazonaws\.com"


@dataclass(frozen=True)
class Dialect:
    """Subclass or instantiate with other values to catalog another server family."""

    system_schemas: tuple[str, ...] = SYSTEM_SCHEMAS
    kept_table_types: tuple[str, ...] = KEPT_TABLE_TYPES
    table_count_types: tuple[str, ...] = TABLE_COUNT_TYPES
    view_count_type: str = VIEW_COUNT_TYPE
    view_kinds: tuple[str, ...] = VIEW_KINDS
    default_catalog: str = DEFAULT_CATALOG
    schema_owner: str = SCHEMA_OWNER
    vendor: str = VENDOR


MYSQL = Dialect()
