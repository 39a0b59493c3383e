"""Encoding and decoding of records as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas

_KEEP_NULLS = {"ignoreNullFields": "false"}


def text(value: Column) -> Column:
    """Record bytes as UTF-8 text."""
    return value.cast("string")


def with_value(records: DataFrame) -> DataFrame:
    """Records whose ``value`` is neither NULL nor empty: those that decode to something."""
    return records.where(F.col("value").isNotNull() & (F.length("value") > 0))


def json_record(value: Column, schema: T.StructType) -> Column:
    """JSON bytes or text as a struct. Malformed JSON fails; NULL or empty input gives NULL."""
    return F.from_json(text(value), schema, {"mode": "FAILFAST"})


def envelope(value: Column, image: T.StructType = schemas.DEMO) -> Column:
    """A change envelope as ``struct<before, after, op>``; other JSON fields are ignored."""
    return json_record(value, schemas.envelope(image))


def to_json(record: Column) -> Column:
    """A struct as JSON text with its NULL fields kept."""
    return F.to_json(record, _KEEP_NULLS)


def delimited(line: Column, schema: T.StructType = schemas.LINE, sep: str = ",") -> list[Column]:
    """The leading fields of a delimited line, cast to ``schema``.

    Fields beyond the schema are ignored; a short line or a bad number fails, in
    ANSI mode and out of it.
    """
    parts = F.split(line, "\\Q" + sep + "\\E")
    columns = []
    for at, field in enumerate(schema.fields):
        raw = parts.getItem(at)
        value = raw
        if not isinstance(field.dataType, T.StringType):
            padded = F.raise_error(F.concat(F.lit("blanks around a value in line: "), line))
            value = F.when(raw.rlike(r"^\s|\s$"), padded).otherwise(raw.cast(field.dataType))
        short = F.size(parts) <= at
        columns.append(
            F.when(line.isNull(), F.lit(None))
            .when(short, F.raise_error(F.concat(F.lit("too few fields in line: "), line)))
            .otherwise(value)
            .cast(field.dataType)
            .alias(field.name)
        )
    return columns


def text_line(name: str, columns: Sequence[str]) -> Column:
    """A row as ``Name(a=1, b=null)``."""
    layout = name + "(" + ", ".join(f"{c}=%s" for c in columns) + ")"
    return F.format_string(layout, *[F.col(c) for c in columns])


def typed_record(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to ``schema``; a NULL in a required field fails."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required field {field.name}")))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def widen(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast ``df`` to a target's column types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def partition_columns(create_time: Column) -> list[Column]:
    """``ts_date``, ``ts_hour`` and ``ts_minute`` of a ``yyyy-MM-dd HH:mm:ss`` text."""
    ts = F.to_timestamp(create_time, "yyyy-MM-dd HH:mm:ss")
    return [
        F.date_format(ts, "yyyyMMdd").alias("ts_date"),
        F.date_format(ts, "HH").alias("ts_hour"),
        F.date_format(ts, "mm").alias("ts_minute"),
    ]
