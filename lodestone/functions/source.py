"""Facts about the source server read from plain values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.dialect import CONNECTION_LIMIT_ERRNOS, RDS_REGION_PATTERN, SERVER_RESTART_ERRNOS


def region_from_host(host: Column) -> Column:
    """Cloud region in a managed-database host name, NULL when the host is not of that form."""
    return F.nullif(F.regexp_extract(host, RDS_REGION_PATTERN, 1), F.lit(""))


def error_class(errno: Column) -> Column:
    """Whether a server error is worth retrying, and why; unknown and missing numbers are definitive."""
    return (
        F.when(errno.isin(*CONNECTION_LIMIT_ERRNOS), "connection_limit")
        .when(errno.isin(*SERVER_RESTART_ERRNOS), "server_restart")
        .otherwise("definitive")
    )
