"""Column masks and row predicates, as Column builders and as SQL functions.

A mask returns the type of the column it replaces, and NULL stays NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from martkeeper.functions.calc import col

# The published form of a masked identifier and of a redacted name.
LAST4_PREFIX = "***-**-"
REDACTED = "[Redacted]"
DEFAULT_REGION = "US West"


def mask_last4(c: str | Column) -> Column:
    """Keep the last four characters. A value of four characters or fewer stays visible."""
    return F.concat(F.lit(LAST4_PREFIX), F.substring(col(c), -4, 4))


def mask_last4_strict(c: str | Column) -> Column:
    """As :func:`mask_last4`, but a value of four characters or fewer shows nothing."""
    value = col(c)
    return F.when(F.length(value) > 4, mask_last4(value)).when(
        value.isNotNull(), F.lit(LAST4_PREFIX + "****")
    )


def mask_dob_year(c: str | Column) -> Column:
    """1 January of the year of the date."""
    return F.trunc(col(c), "YEAR")


def mask_redact(c: str | Column) -> Column:
    """The constant redaction text."""
    return F.when(col(c).isNotNull(), F.lit(REDACTED))


def tokenize_key(c: str | Column, salt: str | None = None) -> Column:
    """Deterministic SHA-256 token: equal keys give equal tokens, so joins keep working.

    Keys that can be enumerated can be reversed by a dictionary; pass one secret ``salt`` for all
    tables that are joined with each other.
    """
    value = col(c) if salt is None else F.concat(F.lit(salt), col(c))
    return F.sha2(value, 256)


def region_row_filter(c: str | Column, allowed: Sequence[str] = (DEFAULT_REGION,)) -> Column:
    """Rows of the permitted regions. A plain comparison, so it reaches the parquet scan."""
    if len(allowed) == 1:
        return col(c) == allowed[0]
    return col(c).isin(*allowed)


SQL_FUNCTIONS = {
    "mask_last4": "(value STRING) RETURNS STRING RETURN "
    f"CONCAT('{LAST4_PREFIX}', SUBSTR(value, -4))",
    "region_row_filter": f"(region STRING) RETURNS BOOLEAN RETURN region = '{DEFAULT_REGION}'",
    "mask_dob_year": "(value DATE) RETURNS DATE RETURN TRUNC(value, 'YEAR')",
    "mask_redact": "(value STRING) RETURNS STRING RETURN "
    f"CASE WHEN value IS NOT NULL THEN '{REDACTED}' END",
    "tokenize_key": "(value STRING) RETURNS STRING RETURN SHA2(value, 256)",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the masks as temporary SQL functions, which Catalyst inlines as expressions."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(SQL_FUNCTIONS)
