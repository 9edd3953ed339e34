"""Column masks. The caller's rights are known when the plan is built, so a
mask is either the column itself or a literal, and a masked column is never
read from storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a masked column shows, and the declared types taken as text.
TEXT_MASK = "***"
CLEARANCE_MASK = "***MASKED***"
NO_PII = "NO_PII"
RESOURCE_TEXT_TYPES = (
    "varchar", "char", "nvarchar", "nchar", "text", "string", "binary", "varbinary",
)
ROLE_TEXT_TYPES = ("varchar", "char", "nvarchar", "nchar", "text", "string")

SECURITY = "security"


def mask_pii(column: str, level: int) -> Column:
    """The value at level 1 or more, else ``***``."""
    return F.col(column) if level >= 1 else F.lit(TEXT_MASK)


def mask_financial(column: str, level: int, data_type: str) -> Column:
    """The value at level 2 or more, else a NULL of the same type."""
    return F.col(column) if level >= 2 else F.lit(None).cast(data_type)


def role_is_restricted(role: str | None) -> bool:
    """Whether the role name itself marks the caller as not allowed to see PII."""
    return role is not None and NO_PII in role


def tag_columns(df: DataFrame, tags: dict[str, dict[str, object]]) -> DataFrame:
    """Attach security tags to columns as field metadata."""
    return df.select(
        *[
            F.col(name).alias(name, metadata={SECURITY: tags[name]}) if name in tags else F.col(name)
            for name in df.columns
        ]
    )
