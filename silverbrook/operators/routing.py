"""Validation of event envelopes and routing by type."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverbrook.functions.events import (
    CONTENT,
    envelope_columns,
    variant_field,
    variant_path,
    with_computed,
)
from silverbrook.schema import ROUTED_TYPES

ERRORS = "errors"
TARGET = "target"
LANDING, STORE, QUARANTINE = "landing", "store", "quarantine"
_BODY = "_body"
_VALID = "_valid"

# Attributes an event must have, in the order errors are listed,
# the accepted version and the messages.
REQUIRED = ("specversion", "id", "source", "type")
SPECVERSION = "1.0"
MISSING = "Field required"
NOT_TEXT = "Input should be a valid string"
BLANK = "Value error, '{}' must be a non-empty string"
UNSUPPORTED = ("Value error, unsupported specversion: ", " — expected '1.0'")
NOT_JSON = "invalid JSON body"
NOT_OBJECT = "request body must be a JSON object"

# Something other than white space; the listed controls count as white space.
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"


def _error(field: str | None, message: Column) -> Column:
    name = F.lit(field) if field else F.lit(None).cast("string")
    return F.struct(name.alias("field"), message.alias("message"))


def _kind(name: str) -> Column:
    """Type of an attribute's value, NULL when it is missing."""
    return F.schema_of_variant(variant_field(variant_path(name), "variant", strict=False))


def _acceptable(name: str) -> Column:
    """Whether the text of a required attribute is fine."""
    text = variant_field(variant_path(name), "string", strict=False)
    return text == F.lit(SPECVERSION) if name == "specversion" else text.rlike(_VISIBLE)


def _attribute_error(name: str) -> Column:
    """The error of one required attribute, NULL when it is fine."""
    kind = _kind(name)
    if name == "specversion":
        text = variant_field(variant_path(name), "string", strict=False)
        quote = F.when(text.contains("'") & ~text.contains('"'), '"').otherwise("'")
        message = F.concat(F.lit(UNSUPPORTED[0]), quote, text, quote, F.lit(UNSUPPORTED[1]))
    else:
        message = F.lit(BLANK.format(name))
    return (
        F.when(kind.isNull(), _error(name, F.lit(MISSING)))
        .when(kind != "STRING", _error(name, F.lit(NOT_TEXT)))
        .when(~_acceptable(name), _error(name, message))
    )


def one_document(body: Column) -> Column:
    """The parsed text, NULL unless it is exactly one JSON value.

    Spark's parser stops after the first value and ignores what follows. Put
    between brackets the text must be an array of one element, and put into an
    object it must be the value of its only field; text after the first value
    breaks one or the other. Both checks only skip over the text. A text
    without a closing bracket cannot end the array before its own end, so the
    first check alone tells all of it.
    """
    elements = F.json_array_length(F.concat(F.lit("["), body, F.lit("]")))
    fields = F.json_object_keys(F.concat(F.lit('{"v":'), body, F.lit("}")))
    alone = (elements == 1) & (~F.contains(body, F.lit("]")) | (F.size(fields) == 1))
    return F.when(alone, F.try_parse_json(body))


def _parse(df: DataFrame, text: str) -> DataFrame:
    """Parse every text once; an empty body counts as an empty object."""
    body = F.coalesce(F.nullif(F.col(text), F.lit("")), F.lit("{}"))
    return with_computed(df.withColumn(_BODY, body), CONTENT, one_document(F.col(_BODY)))


def _is_object() -> Column:
    return F.col(_BODY).rlike(r"^\s*\{")


def _is_valid() -> Column:
    sound = [(_kind(name) == "STRING") & _acceptable(name) for name in REQUIRED]
    checks = reduce(and_, sound, F.col(CONTENT).isNotNull() & _is_object())
    return F.coalesce(checks, F.lit(False))


def _errors() -> Column:
    by_attribute = F.array_compact(F.array(*[_attribute_error(name) for name in REQUIRED]))
    return (
        F.when(F.col(CONTENT).isNull(), F.array(_error(None, F.lit(NOT_JSON))))
        .when(~_is_object(), F.array(_error(None, F.lit(NOT_OBJECT))))
        .otherwise(by_attribute)
    )


def validate_events(df: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Acceptable events, and rejected ones with what is wrong with each.

    Acceptable events gain the parsed event and its envelope columns; extra
    attributes stay in the parsed event. Rejected ones gain an ``errors``
    array of (field, message). Other columns pass through in both.
    """
    parsed = _parse(df, text)
    valid = parsed.filter(_is_valid()).select(
        *df.columns, CONTENT, *envelope_columns(strict=False)
    )
    rejected = parsed.filter(~_is_valid()).select(*df.columns, _errors().alias(ERRORS))
    return valid, rejected


def judge_events(
    df: DataFrame, routed_types: Iterable[str] = ROUTED_TYPES, text: str = "value"
) -> DataFrame:
    """Validate and route in one projection over one parse of each text.

    Adds the parsed event and its envelope columns (NULL for rejected events),
    ``errors`` (NULL for acceptable ones) and ``target``: ``landing``, ``store`` or
    ``quarantine``. Write it once and every sink can read its own part.
    """
    judged = with_computed(_parse(df, text), _VALID, _is_valid())
    valid = F.col(_VALID)
    routed = valid & F.coalesce(
        variant_field("$.type", "string", strict=False).isin(*routed_types), F.lit(False)
    )
    names = [c for c in df.columns if c != CONTENT]
    envelope = judged.select(*envelope_columns(strict=False)).columns
    own = [F.when(valid, c).alias(n) for c, n in zip(envelope_columns(strict=False), envelope, strict=True)]
    return judged.select(
        *names,
        F.when(valid, F.col(CONTENT)).alias(CONTENT),
        *own,
        F.when(~valid, _errors()).alias(ERRORS),
        F.when(routed, LANDING).when(valid, STORE).otherwise(QUARANTINE).alias(TARGET),
    )


def route_events(
    df: DataFrame, routed_types: Iterable[str] = ROUTED_TYPES, type_col: str = "ce_type"
) -> tuple[DataFrame, DataFrame]:
    """Split events between the landing table (listed types) and the file store (the rest)."""
    listed = F.coalesce(F.col(type_col).isin(*routed_types), F.lit(False))
    return df.filter(listed), df.filter(~listed)
