"""JSON text columns: encoding rows, decoding messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEEP_NULLS = {"ignoreNullFields": "false"}


def named(name: str) -> Column:
    """The top-level column called exactly ``name``, dots included."""
    return F.col(f"`{name}`")


def json_object(*fields: str | Column, keep_nulls: bool = False) -> Column:
    """The fields as one JSON object text. Null fields are left out unless ``keep_nulls``."""
    packed = F.struct(*[named(f) if isinstance(f, str) and f != "*" else f for f in fields])
    return F.to_json(packed, KEEP_NULLS if keep_nulls else None)


def parsed_message(
    value: Column | str, schema: T.StructType, corrupt_column: str | None = None
) -> Column:
    """The message text as a struct of ``schema``.

    A field that is absent or of the wrong type is null, text that is not JSON gives all nulls.
    With ``corrupt_column`` the struct gets one more field, holding text that would not parse.
    """
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    if corrupt_column is None:
        return F.from_json(text, schema)
    wider = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType(), True)])
    return F.from_json(text, wider, {"columnNameOfCorruptRecord": corrupt_column})


def string_schema(names: Iterable[str]) -> T.StructType:
    """A schema in which every column is nullable text."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])
