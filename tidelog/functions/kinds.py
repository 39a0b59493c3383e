"""Operation codes and row kinds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operation codes of a change envelope and their names.
OP_NAMES = {
    "r": "READ",
    "c": "CREATE",
    "u": "UPDATE",
    "d": "DELETE",
    "t": "TRUNCATE",
    "m": "MESSAGE",
}

# Short strings of the row kinds of a changelog.
INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def op_name(op: Column) -> Column:
    """Name of an operation code; NULL when the code is unknown."""
    name = F.lit(None).cast("string")
    for code, text in OP_NAMES.items():
        name = F.when(op == code, text).otherwise(name)
    return name


def row_kind_op(kind: Column) -> Column:
    """The statement a row kind stands for; anything unknown counts as an insert."""
    return (
        F.when(kind.isin(UPDATE_BEFORE, UPDATE_AFTER), "UPDATE")
        .when(kind == DELETE, "DELETE")
        .otherwise("INSERT")
    )


def is_add(kind: Column) -> Column:
    """Whether a row kind adds a row rather than retracting one."""
    return kind.isin(INSERT, UPDATE_AFTER)
