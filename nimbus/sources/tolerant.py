"""Reading typed records from JSON without losing a value or a line.

A JSON reader with declared types drops what does not fit: ``45.0`` in an
integer field reads NULL, a broken line becomes a row of NULLs. Here every
leaf of the schema, however deep in structs and arrays, is read as text and
typed with ``try_cast`` afterwards:

* a whole number may be written as a decimal (``45.0``) or as text (``"45"``);
* a leaf whose text does not parse is NULL, and its path is named in
  ``_malformed`` (``main.humidity``, ``weather[].id``; comma-separated, empty
  for a row that parsed);
* a line that is no record, or no record of that shape, is kept as text in
  ``_corrupt_record`` and named ``corrupt_record`` in ``_malformed``.

All of it are column expressions; validation sends such rows to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nimbus.operators.validate import MALFORMED

CORRUPT = "_corrupt_record"


def as_text(t: T.DataType) -> T.DataType:
    """The same shape with every leaf a string."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(as_text(t.elementType), True)
    return T.StringType()


def text_schema(schema: T.StructType, extra: list[T.StructField] = ()) -> T.StructType:
    """What to read: ``schema`` as text, the line if it is broken, and
    ``extra`` (partition columns) as they are."""
    return T.StructType([*as_text(schema).fields, T.StructField(CORRUPT, T.StringType(), True), *extra])


def cast_number(c: Column, t: T.DataType) -> Column:
    """``c`` as ``t``, NULL where that would change it: a fraction in an
    integer field is malformed, a whole decimal is not."""
    if not isinstance(t, T.IntegralType):
        return c.try_cast(t)
    number = c.try_cast("double")
    # The cast itself first (long numbers are exact); of a double it would cut the fraction off.
    return F.when(number == F.floor(number), F.coalesce(c.try_cast(t), number.try_cast(t)))


def typed(c: Column, t: T.DataType) -> Column:
    """A text-leaved column with its leaves typed as in ``t``."""
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[typed(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: typed(x, t.elementType))
    return c if isinstance(t, T.StringType) else cast_number(c, t)


def bad_paths(c: Column, t: T.DataType, path: str) -> list[Column]:
    """For the leaves of ``c``: their path where the text does not parse, else
    NULL (or blank)."""
    if isinstance(t, T.StructType):
        return [p for f in t.fields for p in bad_paths(c.getField(f.name), f.dataType, f"{path}.{f.name}")]
    if isinstance(t, T.ArrayType):
        if not bad_paths(c, t.elementType, path):
            return []
        each = F.transform(c, lambda x: F.concat_ws(",", *bad_paths(x, t.elementType, f"{path}[]")))
        return [F.when(c.isNotNull(), F.nullif(F.array_join(F.array_distinct(F.filter(each, lambda s: s != "")), ","), F.lit("")))]
    if isinstance(t, T.StringType):
        return []
    return [F.when(c.isNotNull() & cast_number(c, t).isNull(), F.lit(path))]


def type_records(df: DataFrame, schema: T.StructType, extra: list[str] = ()) -> DataFrame:
    """Rows read with ``text_schema``, typed: the columns of ``schema``,
    ``_corrupt_record``, ``extra`` and ``_malformed`` (with what the record
    itself says there: a landed reading names what its source document had)."""
    corrupt = F.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt_record"))
    said = [F.nullif(F.col(MALFORMED), F.lit(""))] if MALFORMED in df.columns else []
    # concat_ws skips NULLs and stays in whole-stage codegen, unlike array functions
    bad = F.concat_ws(",", corrupt, *said, *[p for f in schema.fields for p in bad_paths(F.col(f"`{f.name}`"), f.dataType, f.name)])
    return df.select(*[typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields], CORRUPT, *extra, bad.alias(MALFORMED))


def json_records(reader, schema: T.StructType, extra: list[T.StructField] = ()):
    """A reader set up for ``type_records``."""
    return (reader.schema(text_schema(schema, extra)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
