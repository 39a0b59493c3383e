"""The record shapes the toolkit works with. Nothing is inferred from data."""

from __future__ import annotations

import json

from pyspark.sql import types as T

KEYS = ("id",)
COLUMNS = ("id", "actor", "alias")

DEMO = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("actor", T.StringType()),
        T.StructField("alias", T.StringType()),
    ]
)
DEMO_WIDE = T.StructType([T.StructField("id", T.LongType()), *DEMO.fields[1:]])
PERSON = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("id", T.IntegerType(), False)]
)
LINE = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

DEMO_AVRO_JSON = json.dumps(
    {
        "type": "record",
        "name": "demo",
        "fields": [
            {"name": "id", "type": "long"},
            {"name": "actor", "type": "string"},
            {"name": "alias", "type": "string"},
        ],
    }
)

# Avro primitive type names and their Spark types.
AVRO_TYPES = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}


def envelope(image: T.StructType = DEMO) -> T.StructType:
    """Schema of a change envelope whose before and after images have ``image``'s shape."""
    return T.StructType(
        [
            T.StructField("before", image),
            T.StructField("after", image),
            T.StructField("op", T.StringType()),
        ]
    )


def from_avro_json(text: str) -> T.StructType:
    """Turn an Avro record schema given as JSON text into a ``StructType``.

    A union with ``null`` makes a field nullable; every other field is required.
    """
    spec = json.loads(text)
    if spec.get("type") != "record":
        raise ValueError("an Avro record schema is expected")
    fields = []
    for field in spec["fields"]:
        kinds = field["type"] if isinstance(field["type"], list) else [field["type"]]
        named = [k for k in kinds if k != "null"]
        if len(named) != 1 or not isinstance(named[0], str) or named[0] not in AVRO_TYPES:
            raise ValueError(f"unsupported Avro type for field {field['name']}: {field['type']}")
        fields.append(T.StructField(field["name"], AVRO_TYPES[named[0]], "null" in kinds))
    return T.StructType(fields)
