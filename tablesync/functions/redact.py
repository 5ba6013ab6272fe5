"""Remove row data and column values from reject messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EMPTY_TEXT = "Data validation errors detected. Row data has been redacted for security."  # fixed value

# fixed values: quoted values after the word Value, in the order they are tried; none of them reaches over a line end
VALUE_PATTERNS = (r"Value[^\S\n]+''[^'\n]*''", r"Value[^\S\n]+'[^'\n]*'", r'Value[^\S\n]+"[^"\n]*"')
VALUE_TEXT = "column value"


def redact_column(col: Column) -> Column:
    """Per line: quoted values become ``column value``, everything from ``Row:`` on is cut, empty lines go.

    Null and blank messages stay as they are; a message with nothing left becomes a fixed text.
    """
    text = F.regexp_replace(col, r"\r\n?", "\n")
    for pattern in VALUE_PATTERNS:
        text = F.regexp_replace(text, pattern, VALUE_TEXT)
    text = F.regexp_replace(text, r"Row:[^\n]*", "")
    text = F.regexp_replace(text, r"\n(?:[^\S\n]*\n)+", "\n")
    text = F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))
    filled = F.coalesce(F.nullif(text, F.lit("")), F.lit(EMPTY_TEXT))
    return F.when(col.rlike(r"\S"), filled).otherwise(col)


def redact(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, redact_column(F.col(col)))
