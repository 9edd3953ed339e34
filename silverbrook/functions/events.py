"""Column expressions over event envelopes held as variants."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook.schema import Column as DeclaredColumn
from silverbrook.schema import spark_type

CONTENT = "record_content"

# Envelope column -> top-level attribute of the event.
ENVELOPE = {
    "ce_id": "id",
    "ce_type": "type",
    "ce_source": "source",
    "ce_specversion": "specversion",
    "ce_time": "time",
    "ce_subject": "subject",
}


def entity_key(event_type: Column | str) -> Column:
    """The event type without its last dotted segment; ``""`` when it has none."""
    text = F.col(event_type) if isinstance(event_type, str) else event_type
    last = F.char_length(F.substring_index(text, ".", -1))
    return F.left(text, F.char_length(text) - last - 1)


def variant_path(*segments: str) -> str:
    """JSON path of nested fields, quoting names that are not identifiers."""
    return "$" + "".join(
        f".{s}" if re.fullmatch(r"[A-Za-z_]\w*", s) else f"['{s}']" for s in segments
    )


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    Catalyst moves a filter below a projection by repeating the projected
    expression, so a filter on a parsed text would parse it again. It does not
    do so across a generator, which here yields exactly one row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def variant_field(path: str, data_type: str, strict: bool, content: str = CONTENT) -> Column:
    get = F.variant_get if strict else F.try_variant_get
    return get(F.col(content), path, data_type)


def envelope_columns(strict: bool = True, content: str = CONTENT) -> list[Column]:
    """The six envelope attributes; the time as an instant, the rest as text."""
    return [
        variant_field(
            variant_path(attribute),
            "timestamp" if name == "ce_time" else "string",
            strict,
            content,
        ).alias(name)
        for name, attribute in ENVELOPE.items()
    ]


def extract_typed(
    df: DataFrame,
    columns: Iterable[DeclaredColumn],
    strict: bool = True,
    number_scale: int = 2,
    content: str = CONTENT,
    keep: Iterable[str] = (),
) -> DataFrame:
    """One projection from the variant to the declared, typed columns.

    ``strict`` raises on a value that does not convert; otherwise it becomes
    NULL. A missing path is NULL either way. ``keep`` names columns of ``df``
    to carry along.
    """
    out = []
    for column in columns:
        if column.name in ENVELOPE:
            path = variant_path(ENVELOPE[column.name])
        else:
            path = variant_path("data", column.name)
        target = spark_type(column.data_type, number_scale)
        out.append(variant_field(path, target, strict, content).alias(column.name))
    return df.select(*out, *keep)
