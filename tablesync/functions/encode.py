"""Row encoding as column expressions: normalisation, CSV and JSON text, nested values, JSON promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..spec import OP, TableSpec
from ..types import split_type

DATE_FORMAT = "yyyy-MM-dd"
NULL_TEXT = "\\N"  # fixed value: null in CSV


def parse_delimiter(text: str | None, default: str) -> str:
    """Separator option: plain text, or ``\\x`` followed by hex digits."""
    if not text:
        return default
    if text[:2].upper() != "\\X":
        return text
    digits = text[2:]
    if not digits:
        raise ValueError("delimiter: hex string is empty")
    if len(digits) % 2:
        raise ValueError("delimiter: hex string has an odd length")
    try:
        return bytes.fromhex(digits).decode("latin-1")
    except ValueError:
        raise ValueError(f"delimiter: {digits} is not hex") from None


def binary_to_bigint(col: Column) -> Column:
    """Big-endian bytes as a signed 64-bit integer; null for more than eight bytes."""
    number = F.conv(F.hex(col), 16, -10).cast("bigint")
    return F.when(F.length(col) == 0, F.lit(0).cast("bigint")).when(F.length(col) <= 8, number)


def _iso_text(col: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss.SSSSSS``, taken from the plain text form so that no session zone moves a zoneless time."""
    text = col.cast("string")
    seconds = F.regexp_replace(F.substring_index(text, ".", 1), " ", "T")
    fraction = F.when(text.contains("."), F.substring_index(text, ".", -1)).otherwise("")
    return F.concat(seconds, F.lit("."), F.rpad(fraction, 6, "0"))


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def load_value(col: Column, dtype: T.DataType, as_text: bool = False) -> Column:
    """A value as it enters a load. ``as_text`` says that a struct goes to a text column."""
    if isinstance(dtype, T.BooleanType):
        return col.cast("int")
    if isinstance(dtype, T.DateType):
        return F.date_format(col, DATE_FORMAT)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _iso_text(col)
    if isinstance(dtype, T.BinaryType):
        return binary_to_bigint(col)
    if isinstance(dtype, T.StructType):
        row = _struct(col, dtype)
        return F.to_json(row) if as_text else row
    if isinstance(dtype, T.ArrayType):
        return _array(col, dtype)
    if isinstance(dtype, T.MapType):
        return _map(col, dtype)
    return col


def _struct(col: Column, dtype: T.StructType) -> Column:
    fields = [load_value(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
    return F.when(col.isNotNull(), F.struct(*fields))


def _array(col: Column, dtype: T.ArrayType) -> Column:
    """Elements that are rows become JSON text, dates text; nested arrays and maps are converted."""
    element = dtype.elementType
    if isinstance(element, T.StructType):
        return F.transform(col, lambda x: F.to_json(_struct(x, element)))
    if _nested(element) or isinstance(element, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.transform(col, lambda x: load_value(x, element))
    return col


def _map(col: Column, dtype: T.MapType) -> Column:
    """Keys become text; date, array and map values are converted."""
    value = dtype.valueType
    if _nested(value) or isinstance(value, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        col = F.transform_values(col, lambda k, v: load_value(v, value))
    if isinstance(dtype.keyType, T.StringType):
        return col
    return F.transform_keys(col, lambda k, v: k.cast("string"))


def _target_type(spec: TableSpec | None, name: str) -> str | None:
    if spec is None:
        return None
    for c in spec.columns:
        if c.name.lower() == name.lower():
            return split_type(c.type)[0]
    return "UNKNOWN"


def normalize_for_load(df: DataFrame, spec: TableSpec | None = None) -> DataFrame:
    """All columns as a load sends them: booleans 1/0, dates and times as text, binary as integer, nested converted.

    With ``spec``, text for a JSON (or unknown) column that looks like a JSON document is promoted to JSON, and rows for
    a STRING column become JSON text.
    """
    out = []
    for f in df.schema.fields:
        target = _target_type(spec, f.name)
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and target in ("JSON", "JSONB", "UNKNOWN") and f.name != OP:
            value = to_json_column(col)
        else:
            value = load_value(col, f.dataType, as_text=target == "STRING")
        out.append(value.alias(f.name))
    return df.select(*out)


nested_to_load = normalize_for_load


def to_json_column(col: Column) -> Column:
    """Text to a JSON value: text starting with ``{`` or ``[`` is parsed (malformed text is an error), all other text,
    the empty one too, stays a JSON string."""
    quoted = F.to_json(F.array(col))
    as_string = F.parse_json(F.substring(quoted, F.lit(2), F.length(quoted) - 2))
    return F.when(col.rlike(r"^[\[{]"), F.parse_json(F.when(col.rlike(r"^[\[{]"), col))).when(col.isNotNull(), as_string)


def encode_json(df: DataFrame, spec: TableSpec | None = None, with_op: bool = False, out: str = "value") -> DataFrame:
    """Rows as JSON text, null fields left out. ``with_op`` keeps the ``__op`` column in the text."""
    rows = normalize_for_load(df, spec)
    names = [c for c in rows.columns if with_op or c != OP]
    return rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])).alias(out))


def encode_csv(
    df: DataFrame,
    sep: str | None = None,
    spec: TableSpec | None = None,
    with_op: bool = False,
    out: str = "value",
    fail_on_separator: bool = False,
    row_delimiter: str = "\n",
) -> DataFrame:
    """Rows as CSV text: tab by default, null as ``\\N``, nested values as JSON, nothing quoted or escaped.

    ``fail_on_separator`` raises when a value contains the separator or the row delimiter.
    """
    sep = parse_delimiter(sep, "\t")
    rows = normalize_for_load(df, spec)
    texts = []
    for f in rows.schema.fields:
        if f.name == OP and not with_op:
            continue
        col = F.col(f"`{f.name}`")
        text = F.to_json(col) if _nested(f.dataType) else col.cast("string")
        if fail_on_separator:
            clash = text.contains(sep) | text.contains(row_delimiter)
            text = F.when(clash, F.raise_error(F.lit(f"separator inside column {f.name}")).cast("string")).otherwise(text)
        texts.append(F.coalesce(text, F.lit(NULL_TEXT)))
    return rows.select(F.concat_ws(sep, *texts).alias(out))
