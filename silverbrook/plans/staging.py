"""Staging tables: the latest version of each entity from its raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from silverbrook.functions.events import CONTENT, extract_typed, variant_field
from silverbrook.operators.dedup import latest_per_key
from silverbrook.operators.incremental import LOOKBACK_SECONDS, look_back_from
from silverbrook.schema import CLICK_COLUMNS, CLICK_EVENT_TYPE, EntitySpec
from silverbrook.sources.tables import Check, VersionedTable

# The event id is kept in the stored table to settle ties on time.
EVENT_ID = "_event_id"
# The typed column of the envelope's time.
EVENT_TIME = "ce_time"


def typed_versions(
    raw: DataFrame, spec: EntitySpec, strict: bool = True, number_scale: int = 2
) -> DataFrame:
    """Every event of the entity as a typed row with its event id."""
    with_id = raw.withColumn(EVENT_ID, variant_field("$.id", "string", strict=False))
    return extract_typed(with_id, spec.columns, strict, number_scale, keep=[EVENT_ID])


def latest_versions(
    raw: DataFrame, spec: EntitySpec, strict: bool = True, number_scale: int = 2
) -> DataFrame:
    """The newest version of each entity, before the table columns are picked."""
    return _latest(typed_versions(raw, spec, strict, number_scale), spec)


def _latest(versions: DataFrame, spec: EntitySpec) -> DataFrame:
    return latest_per_key(versions, spec.keys, spec.time_column, "first", [EVENT_ID])


def staged(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """The declared columns of a staging table."""
    return df.select(*spec.column_names)


def _event_time(raw: DataFrame, strict: bool) -> Column:
    """The event's time: the typed column where it is filled, else the event itself.

    The typed column is NULL both for a missing and for an unreadable time. With
    ``strict`` the latter raises here, as it does in a full run.
    """
    inside = variant_field("$.time", "timestamp", strict=strict, content=CONTENT)
    return F.coalesce(F.col("ce_time"), inside) if "ce_time" in raw.columns else inside


def _recent(raw: DataFrame, bound: Column, strict: bool) -> DataFrame:
    """Events from the bound on; those without a time are left out."""
    if "ce_time" in raw.columns:
        # The typed column alone, in a form that the Parquet reader can use.
        raw = raw.filter((F.col("ce_time") >= bound) | F.col("ce_time").isNull())
    return raw.filter(_event_time(raw, strict) >= bound)


def stage_entity(
    raw: DataFrame,
    spec: EntitySpec,
    table: VersionedTable,
    mode: str = "incremental",
    strict: bool = True,
    number_scale: int = 2,
    lookback_seconds: int = LOOKBACK_SECONDS,
    check: Check | None = None,
) -> DataFrame:
    """Bring a staging table up to date with its raw events and return it.

    ``full`` rebuilds it from all events. ``incremental`` reads the events
    from the look-back on, keeps the newest per key and merges them; the first
    run has no table yet and takes everything. ``check`` sees the new version
    before readers do and may raise.
    """
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    newest = table.newest() if mode == "incremental" else None
    if mode == "full" or (newest is None and not table.exists()):
        table.replace(latest_versions(raw, spec, strict, number_scale), check=check)
    else:
        if newest is None:
            newest = table.read().agg(F.max(spec.time_column)).scalar()
        recent = _recent(raw, look_back_from(newest, lookback_seconds), strict)
        table.merge(latest_versions(recent, spec, strict, number_scale), check=check)
    return staged(table.read(), spec)


def stage_new_events(
    events: DataFrame,
    spec: EntitySpec,
    table: VersionedTable,
    strict: bool = True,
    number_scale: int = 2,
    lookback_seconds: int = LOOKBACK_SECONDS,
    check: Check | None = None,
    typed: bool = False,
) -> None:
    """Merge newly arrived events only, as a stream hands them over.

    The table's own version of a key competes with the new ones by time, which
    gives what re-reading the raw events within the look-back would give.
    Events that came too late or have no time are not staged; their numbers
    are kept with the commit (``Version.counts``). ``typed`` events are already
    those of ``typed_versions``.
    """
    counts = None
    newest = table.newest()
    if newest is None and table.exists():
        newest = table.read().agg(F.max(spec.time_column)).scalar()
    if newest is not None:
        bound = look_back_from(newest, lookback_seconds)
        time = F.col(EVENT_TIME) if typed else _event_time(events, strict)
        seen = Observation()
        events = events.observe(
            seen,
            F.count_if(time < bound).alias("late_rows"),
            F.count_if(time.isNull()).alias("untimed_rows"),
        )
        events = events.filter(time >= bound) if typed else _recent(events, bound, strict)

        def counts() -> dict[str, int]:
            return seen.get

    batch = _latest(events if typed else typed_versions(events, spec, strict, number_scale), spec)
    table.merge(batch, newest_by=spec.time_column, tie_break=[EVENT_ID], check=check, counts=counts)


def clicks_projection(landed: DataFrame, strict: bool = True) -> DataFrame:
    """Typed click rows of the landing table; the same for a batch and a stream."""
    clicks = landed.filter(
        variant_field("$.type", "string", strict=False) == F.lit(CLICK_EVENT_TYPE)
    )
    return extract_typed(clicks, CLICK_COLUMNS, strict, keep=["ingested_at"])


def clicks_dedup(clicks: DataFrame) -> DataFrame:
    """The latest event of each click."""
    return latest_per_key(clicks, ["click_id"], "ce_time", "first", ["ce_id"])
