"""Change envelopes whose row images have no known schema.

Images are kept as ``VARIANT`` values. The schema of a feed is agreed by an aggregate over all
its images (one line of text reaches the driver), and widened where images disagree: whole and
fractional numbers become doubles, anything else that conflicts becomes text. A field that some
images lack is NULL there; one whose case differs is a field of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of variant types in a schema line, and the types of columns read from them.
COLUMN_TYPES = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def variant_envelope(value: Column) -> Column:
    """``struct(op, before, after)`` of a JSON envelope, the images as variants; bad JSON fails.

    A JSON ``null`` image is NULL. Fields besides these three are ignored.
    """
    whole = F.parse_json(value.cast("string"))

    def image(side: str) -> Column:
        found = F.variant_get(whole, f"$.{side}", "variant")
        return F.when(~F.is_variant_null(found), found)

    return F.struct(
        F.variant_get(whole, "$.op", "string").alias("op"), image("before").alias("before"), image("after").alias("after")
    )


def _fields(line: str) -> list[tuple[str, str]]:
    """Names and types of the outermost fields of ``OBJECT<name: type, ...>``."""
    body = re.fullmatch(r"OBJECT<(.*)>", line.strip(), re.S)
    if body is None:
        raise ValueError(f"row images are not objects but {line}")
    parts, depth, quoted, start = [], 0, False, 0
    text = body[1]
    for i, c in enumerate(text):
        quoted ^= c == "`"
        if quoted:
            continue
        depth += (c in "<(") - (c in ">)")
        if c == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    parts.append(text[start:])
    pairs = [p.strip() for p in parts if p.strip()]
    split = [re.fullmatch(r"(`(?:[^`]|``)*`|[^:]*):\s*(.*)", p, re.S) for p in pairs]
    return [(m[1].strip().strip("`").replace("``", "`"), m[2].strip()) for m in split]


def agreed_schema(changes: DataFrame, sides: tuple[str, ...] = ("before", "after")) -> T.StructType:
    """One schema for the variant images of a feed: the union of their fields, widened."""
    images = changes.select(F.explode(F.array(*sides)).alias("image")).where("image is not null")
    line = images.agg(F.schema_of_variant_agg("image")).first()[0]
    if line is None or line == "VOID":
        return T.StructType([])
    out = []
    for name, kind in _fields(line):
        decimal = re.fullmatch(r"DECIMAL\((\d+),\s*(\d+)\)", kind)
        column = T.DoubleType() if decimal else COLUMN_TYPES.get(kind, T.StringType())
        out.append(T.StructField(name, column))
    return T.StructType(out)


def typed_image(image: Column, schema: T.StructType) -> Column:
    """A variant image as a struct of ``schema``, NULL for a NULL image; nested values become JSON text."""
    fields = []
    for f in schema.fields:
        path = "$['" + f.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
        fields.append(F.variant_get(image, path, f.dataType.simpleString()).alias(f.name))
    return F.when(image.isNotNull(), F.struct(*fields))
