"""Event payload of the stream topic (11 fields) as a JSON ``value`` column.

Built with ``to_json(struct(...))`` per row inside one projection; the
publish itself is a distributed sink (:mod:`quakescope.sources.sinks`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quakescope.schema import PAYLOAD, PAYLOAD_MEASURES, PAYLOAD_STRING_DEFAULTS

# Fixed value: text a missing (null) string field is sent as.
NULL_TEXT = "nan"


NUMERIC_FIELDS = ["latitude", "longitude", "depth", "mag", "nst", "gap", "rms"]
_NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")


def record_ok(df: DataFrame) -> Column:
    """A payload can be built: every numeric field present is null or a number."""
    ok = F.lit(True)
    types = dict(df.dtypes)
    for name in NUMERIC_FIELDS:
        if name in types and types[name] not in _NUMERIC_TYPES:
            c = F.col(name)
            ok = ok & (c.isNull() | c.try_cast("double").isNotNull())
    return ok


def _num(df: DataFrame, name: str, fill: float | None) -> Column:
    if name not in df.columns:
        return F.lit(fill if fill is not None else None).cast("double")
    c = F.col(name).try_cast("double") if dict(df.dtypes)[name] == "string" else F.col(name).cast("double")
    return c if fill is None else F.coalesce(c, F.lit(fill))


def _text(df: DataFrame, name: str, missing: str) -> Column:
    if name not in df.columns:
        return F.lit(missing)
    return F.coalesce(F.col(name).cast("string"), F.lit(NULL_TEXT))


def payload_columns(df: DataFrame, fill: float | None = 0.0) -> DataFrame:
    """The 11 payload fields as typed columns (see ``payload_fields``)."""
    return df.select(*payload_fields(df, fill))


def payload_fields(df: DataFrame, fill: float | None = 0.0) -> list[Column]:
    """The 11 payload fields of a record.

    Null measures (depth, mag, nst, gap, rms) become ``fill`` (0.0; ``None``
    keeps them null), null coordinates become NaN, null strings the text
    ``nan``; a string column absent from the input takes its default.
    """
    cols = []
    for field in PAYLOAD.fields:
        name = field.name
        if name == "time":
            c = _text(df, "time", "")
        elif name in ("latitude", "longitude"):
            c = F.coalesce(_num(df, name, None), F.lit(float("nan")))
        elif name in PAYLOAD_MEASURES:
            c = _num(df, name, fill)
        else:
            c = _text(df, name, PAYLOAD_STRING_DEFAULTS[name])
        cols.append(c.alias(name))
    return cols


def event_payload(df: DataFrame, fill: float | None = 0.0) -> DataFrame:
    """One JSON text per event in column ``value`` (the topic's message body).

    Records whose numeric text does not parse are not sent (they count as
    failed in the ingestion report).
    """
    return df.filter(record_ok(df)).select(event_message(df, fill).alias("value"))


def event_message(df: DataFrame, fill: float | None = 0.0) -> Column:
    """The JSON text of a record's 11 payload fields."""
    return F.to_json(F.struct(*payload_fields(df, fill)))


def decode_payload(messages: DataFrame, nan_as_null: bool = True) -> DataFrame:
    """Parse ``value`` back to the 11 typed fields (consumer side).

    ``nan_as_null`` reads a NaN coordinate (a producer's stand-in for a missing
    one) back as null.
    """
    parsed = messages.select(F.from_json("value", PAYLOAD).alias("p")).select("p.*")
    if nan_as_null:
        parsed = parsed.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double"))
                                     for c in ("latitude", "longitude")})
    return parsed


def payload_volume(messages: DataFrame) -> DataFrame:
    """Messages, bytes and MB actually built (the ingestion report estimates 200 B each)."""
    size = F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("bigint")
    return messages.agg(F.count(F.lit(1)).alias("messages"), size.alias("payload_bytes"),
                        F.round(size.cast("double") / F.lit(1024.0 * 1024.0), 2).alias("payload_mb"))
