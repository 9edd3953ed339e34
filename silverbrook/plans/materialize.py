"""How the models of each layer are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from silverbrook.sources.tables import VersionedTable
from silverbrook.streaming.landing import CLICKS_INTERVAL, Audit, start_append, start_audited

# The way each layer's models are stored.
LAYERS = {"staging": "incremental", "clicks": "stream", "marts": "table", "secured": "view"}


def materialize(
    df: DataFrame,
    name: str,
    mode: str,
    table: VersionedTable | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
    interval: str | None = CLICKS_INTERVAL,
    check: Audit | None = None,
    refused: str | None = None,
) -> DataFrame | StreamingQuery:
    """Store a model and return what readers see, or the running query of a stream.

    ``table`` rebuilds a table, ``incremental`` merges by its keys, ``view``
    stores nothing, ``stream`` appends to the files below ``path``. ``check`` sees
    a table's new version before readers do and may raise. Of a stream it sees
    each micro-batch: those for which it returns something go to ``refused``.
    """
    if mode == "view":
        df.createOrReplaceTempView(name)
        return df
    if mode == "stream":
        if path is None or checkpoint is None:
            raise ValueError("a stream needs a path and a checkpoint")
        if check is not None:
            if refused is None:
                raise ValueError("a checked stream needs a place for refused batches")
            return start_audited(df, path, refused, checkpoint, check, interval)
        return start_append(df, path, checkpoint, interval=interval)
    if mode not in ("table", "incremental"):
        raise ValueError(f"unknown mode {mode!r}")
    if table is None:
        raise ValueError(f"{mode} needs a table")
    if mode == "table":
        table.replace(df, check=check)
    else:
        table.merge(df, check=check)
    return table.read()
