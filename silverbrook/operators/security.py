"""Row filters and column masks by entitlement.

Entitlements are looked up once per call, when the plan is built, by an
aggregate that returns at most one row per resource. The filter that results
is a constant, a pushed-down ``IN`` or a semi join, never a nested loop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from silverbrook.functions.masks import (
    CLEARANCE_MASK,
    RESOURCE_TEXT_TYPES,
    ROLE_TEXT_TYPES,
    SECURITY,
    TEXT_MASK,
    mask_financial,
    mask_pii,
    role_is_restricted,
)
from silverbrook.schema import RESOURCES

WILDCARD = "*"
ALL_REGIONS = "ALL"
# Up to this many object ids go into the plan as literals; more are joined.
LITERAL_IDS = 1000


@dataclass(frozen=True)
class Access:
    """What one user may do with one resource."""

    level: int = 0
    wildcard: bool = False


class InvalidEntitlements(ValueError):
    """Grants that break the table's constraints; nothing is granted by them."""


def resolve_access(entitlements: DataFrame, user_id: int | None) -> dict[str, Access]:
    """The user's highest level and wildcard per resource; nothing without a user.

    A grant of the user's with a level outside 0 to 2 or without an object
    breaks the table's constraints and is refused.
    """
    if user_id is None:
        return {}
    rows = (
        entitlements.filter((F.col("user_id") == user_id) & F.col("resource").isin(*RESOURCES))
        .groupBy("resource")
        .agg(
            F.max("access_level").alias("level"),
            F.bool_or((F.col("object_id") == WILDCARD) & (F.col("access_level") > 0)).alias("wild"),
            F.count_if(
                ~F.coalesce(F.col("access_level").isin(0, 1, 2), F.lit(False)) | F.col("object_id").isNull()
            ).alias("bad"),
        )
        .collect()
    )
    if any(r["bad"] for r in rows):
        raise InvalidEntitlements(f"user {user_id} has grants that break the table's constraints")
    return {r["resource"]: Access(int(r["level"] or 0), bool(r["wild"])) for r in rows}


def _keep_members(df: DataFrame, key: str, members: DataFrame, member_col: str) -> DataFrame:
    """Rows whose key is a member: literals when there are few, else a semi join."""
    found = members.limit(LITERAL_IDS + 1).collect()
    if len(found) <= LITERAL_IDS:
        values = [r[0] for r in found]
        return df.filter(F.col(key).isin(*values)) if values else df.filter(F.lit(False))
    return df.join(members, F.col(key) == F.col(member_col), "left_semi")


def row_access(
    df: DataFrame,
    entitlements: DataFrame,
    user_id: int | None,
    resource: str,
    pk: str,
    access: Access | None = None,
) -> DataFrame:
    """Rows the user may see: all with a wildcard grant, else those granted by id."""
    if access is None:
        access = resolve_access(entitlements, user_id).get(resource, Access())
    if user_id is None or access.level <= 0:
        return df.filter(F.lit(False))
    if access.wildcard:
        return df
    granted = entitlements.filter(
        (F.col("user_id") == user_id)
        & (F.col("resource") == resource)
        & (F.col("access_level") > 0)
    )
    if isinstance(df.schema[pk].dataType, IntegralType):
        # Compare as numbers so the filter reaches the scan; an id only counts
        # when it is the number's own text, as in a comparison of texts.
        as_number = F.col("object_id").try_cast("bigint")
        ids = granted.filter(as_number.cast("string") == F.col("object_id")).select(
            as_number.alias("_granted")
        )
    else:
        ids = granted.select(F.col("object_id").alias("_granted"))
        if not isinstance(df.schema[pk].dataType, StringType):
            keyed = df.withColumn("_pk_text", F.col(pk).cast("string"))
            return _keep_members(keyed, "_pk_text", ids.distinct(), "_granted").drop("_pk_text")
    return _keep_members(df, pk, ids.distinct(), "_granted")


def apply_masks(df: DataFrame, access: dict[str, Access]) -> DataFrame:
    """Mask every column whose metadata names a resource.

    Text columns show ``***`` below level 1, others NULL below level 2;
    untagged columns pass. The level is the user's highest on the resource,
    whichever objects it was granted on.
    """
    out: list[Column] = []
    for field in df.schema.fields:
        tag = field.metadata.get(SECURITY) or {}
        resource = tag.get("resource")
        if resource is None:
            out.append(F.col(field.name))
            continue
        level = access.get(resource, Access()).level
        declared = str(tag.get("data_type") or "").strip().lower()
        if declared.startswith(RESOURCE_TEXT_TYPES):
            masked = mask_pii(field.name, level)
        else:
            masked = mask_financial(field.name, level, field.dataType.simpleString())
        out.append(masked.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def apply_role_masks(df: DataFrame, role: str | None) -> DataFrame:
    """Mask PII columns for a role whose name contains ``NO_PII``."""
    restricted = role_is_restricted(role)
    out: list[Column] = []
    for field in df.schema.fields:
        tag = field.metadata.get(SECURITY) or {}
        if not (restricted and tag.get("pii")):
            out.append(F.col(field.name))
            continue
        declared = str(tag.get("data_type") or "varchar").strip().lower()
        if declared.startswith(ROLE_TEXT_TYPES):
            masked = F.lit(TEXT_MASK)
        else:
            masked = F.lit(None).cast(field.dataType)
        out.append(masked.alias(field.name, metadata=field.metadata))
    return df.select(*out)


def active_entitlements(entitlements: DataFrame) -> DataFrame:
    """Grants that grant something."""
    return entitlements.filter("access_level > 0").select(
        "user_id", "resource", "access_level", "object_id"
    )


def active_principals(principals: DataFrame) -> DataFrame:
    """Attributes of active principals."""
    return principals.filter("is_active").select(
        "principal", "region", "department", "pii_clearance"
    )


def region_access(
    df: DataFrame, principals: DataFrame, principal: str | None, region_col: str = "region"
) -> DataFrame:
    """Rows of the principal's regions, or all of them with an ``ALL`` entry."""
    if principal is None:
        return df.filter(F.lit(False))
    regions = (
        active_principals(principals)
        .filter(F.col("principal") == principal)
        .select(F.col("region").alias("_region"))
    )
    # A scalar decides between no filter and a filter, so both are cheap.
    everywhere = regions.agg(F.bool_or(F.col("_region") == ALL_REGIONS)).first()[0]
    if everywhere:
        return df
    return _keep_members(df, region_col, regions.dropna().distinct(), "_region")


def has_clearance(principals: DataFrame, principal: str | None) -> bool:
    """Whether the principal is active and cleared for PII."""
    if principal is None:
        return False
    cleared = active_principals(principals).filter(
        (F.col("principal") == principal) & F.col("pii_clearance")
    )
    return not cleared.isEmpty()


def mask_by_clearance(column: str, cleared: bool) -> Column:
    """The value with clearance, else a fixed mask."""
    return (F.col(column) if cleared else F.lit(CLEARANCE_MASK)).alias(column)
