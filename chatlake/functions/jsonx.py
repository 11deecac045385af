"""Access to raw JSON records. Paths are extracted from the text as written; bad JSON gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

path = F.get_json_object


def record_fields(raw: Column) -> dict[str, Column]:
    """Indexed fields of a session-log record."""
    return {"record_type": path(raw, "$.type"), "record_uuid": path(raw, "$.uuid"), "parent_uuid": path(raw, "$.parentUuid"), "session_id": path(raw, "$.sessionId"), "record_ts": record_time(raw)}


def record_time(raw: Column) -> Column:
    """`timestamp` as ISO text or as milliseconds; zero, missing and anything else is null."""
    t = path(raw, "$.timestamp")
    number = t.rlike(r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$") & ~raw.rlike(r'"timestamp"\s*:\s*"')
    ms = t.try_cast("double")
    return F.when(number, F.when(ms != 0, F.timestamp_millis(ms.cast("bigint")))).otherwise(iso_time(t))


def iso_time(text: Column) -> Column:
    """ISO-8601 text; a time without an offset is UTC; bad text is null."""
    return F.when(text.rlike(r"^\d{4}-\d\d-\d\d"), text.try_cast("timestamp"))


def epoch_time(seconds: Column) -> Column:
    """Seconds since 1970; zero, null and bad values are null."""
    s = seconds.try_cast("double")
    return F.when(s != 0, F.timestamp_micros((s * 1000000).cast("bigint")))


def has_path(raw: Column, name: str) -> Column:
    return path(raw, f"$.{name}").isNotNull()


def content_for_store(raw: Column) -> Column:
    """Normalisation: message, else the text of the first content block, else text, else empty."""
    return F.coalesce(path(raw, "$.message"), path(raw, "$.content[0].text"), path(raw, "$.text"), F.lit(""))


def content_for_vector(raw: Column) -> Column:
    """Embedding: message, else content, else the whole record."""
    return F.coalesce(path(raw, "$.message"), path(raw, "$.content"), compact(raw), raw)


def content_for_topic(raw: Column) -> Column:
    """Segmentation: message, else content, else empty."""
    return F.coalesce(path(raw, "$.message"), path(raw, "$.content"), F.lit(""))


def compact(raw: Column) -> Column:
    """One spelling per JSON value: no blanks, keys sorted."""
    return F.to_json(F.try_parse_json(raw))


def has_image(raw: Column) -> Column:
    """Whether a record carries an image block or an image data URL."""
    c = F.coalesce(compact(raw), raw)
    return F.contains(c, F.lit('"type":"image"')) | F.contains(c, F.lit("data:image/"))


def filled_only(**fields: Column) -> Column:
    """A JSON object of the fields that are neither null, empty text, empty list nor empty object."""
    keep = {k: F.when(~v.isin("", "[]", "{}", "null"), v) for k, v in fields.items()}
    body = F.concat_ws(",", *[F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), v)) for k, v in keep.items()])
    return F.concat(F.lit("{"), body, F.lit("}"))
