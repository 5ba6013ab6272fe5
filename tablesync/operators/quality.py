"""Row checks of a load: bad rows, the ratio gate, the load report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..spec import ColumnSpec, TableSpec
from ..types import split_type

REASONS = "_reasons"
NO_IMAGE = "change event without a row image"


class LoadRejected(RuntimeError):
    """Too many rows of a load were filtered. ``samples`` holds reasons of some of them, without values of rows."""

    def __init__(self, message: str, samples: list[str] | None = None):
        self.samples = samples or []
        super().__init__("\n- ".join([message, *self.samples]))


_LARGEINT_MAX = "170141183460469231731687303715884105727"  # fixed value: 2^127 - 1
_LARGEINT_MIN = "170141183460469231731687303715884105728"  # fixed value: 2^127


def typed(source: Column, column: ColumnSpec, given: T.DataType) -> Column:
    """Input value as the column's type; null where it does not fit."""
    dtype = column.spark
    name, size, _ = split_type(column.type)
    if name == "LARGEINT":
        text = source.cast("string")
        digits = F.regexp_replace(text, r"^[+-]?0*(?=\d)", "")
        padded = F.lpad(digits, 39, "0")
        fits = F.when(text.startswith("-"), padded <= _LARGEINT_MIN).otherwise(padded <= _LARGEINT_MAX)
        return F.when(text.rlike(r"^[+-]?\d+$") & (F.length(digits) <= 39) & fits, text)
    if name in ("CHAR", "VARCHAR") and size is not None:
        text = source.cast("string")
        return F.when(F.octet_length(text) <= size, text)
    if isinstance(given, T.StringType) and isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return nested_of_text(source, dtype)
    if isinstance(given, (T.FloatType, T.DoubleType, T.DecimalType)) and isinstance(dtype, T.IntegralType):
        return F.when(F.floor(source) == source, source.try_cast(dtype))  # a fraction is not cut off
    if isinstance(given, T.StringType) and isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(~source.rlike(r"\A\s*[+-]?[0-9]{5,}"), source.try_cast(dtype))  # a bare number is no year
    if isinstance(given, T.BinaryType) and isinstance(dtype, T.IntegralType):
        from ..functions.encode import binary_to_bigint

        return binary_to_bigint(source).try_cast(dtype)
    return source if given == dtype else source.try_cast(dtype)


def nested_of_text(source: Column, dtype: T.DataType) -> Column:
    """JSON text as ARRAY, MAP or STRUCT; null if the text is no JSON or a value in it does not fit its type."""
    wrapped = T.StructType([T.StructField("v", dtype), T.StructField("_bad", T.StringType())])
    parsed = F.from_json(F.concat(F.lit('{"v":'), source, F.lit("}")), wrapped, {"columnNameOfCorruptRecord": "_bad"})
    return F.when(F.try_parse_json(source).isNotNull() & parsed["_bad"].isNull(), parsed["v"])


def check_rows(df: DataFrame, spec: TableSpec, strict: bool = True) -> DataFrame:
    """One pass over the input: the table's columns typed, plus ``_reasons``, a text that is empty for a good row.

    Input columns are matched by name without case. Columns the table lacks are passed through untouched. In strict mode
    a value that does not fit rejects the row; otherwise it becomes null, which a NOT NULL column still rejects.
    """
    given = {f.name.lower(): f for f in df.schema.fields}
    typed_cols, reasons = [], []
    for c in spec.columns:
        f = given.pop(c.name.lower(), None)
        if f is None:
            value = F.lit(c.default).cast(c.spark)
            failed = None
        else:
            source = F.col(f"`{f.name}`")
            value = typed(source, c, f.dataType)
            failed = source.isNotNull() & value.isNull()
        typed_cols.append(value.alias(c.name))
        if strict and failed is not None:
            shown = source.cast("string") if not isinstance(f.dataType, T.NullType) else F.lit("")
            reasons.append(
                F.when(failed, F.concat(F.lit("Value '"), shown, F.lit(f"' does not fit {c.type} of '{c.name}'")))
            )
        if not c.nullable:
            null = value.isNull() if not strict or failed is None else value.isNull() & ~failed
            reasons.append(F.when(null, F.lit(f"NULL value in non-nullable column '{c.name}'")))
    # a record that could not be decoded carries its reason already
    if REASONS in df.columns:
        given.pop(REASONS)
        reasons.append(F.nullif(F.col(REASONS), F.lit("")))
    passed = [F.col(f"`{f.name}`") for f in given.values()]
    all_reasons = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return df.select(*typed_cols, *passed, all_reasons.alias(REASONS))


def split_valid(df: DataFrame, spec: TableSpec, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Good rows (typed, table columns first) and bad rows with the reason texts in ``_reasons``.

    Both read the same checked rows; persist the input if both are used in one job.
    """
    checked = check_rows(df, spec, strict)
    return checked.where(F.col(REASONS) == "").drop(REASONS), checked.where(F.col(REASONS) != "")


def counts(checked: DataFrame) -> DataFrame:
    """Total, good and filtered rows of checked rows, as one row."""
    bad = F.col(REASONS) != ""
    return checked.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~bad).alias("loaded_rows"),
        F.count_if(bad).alias("filtered_rows"),
    )


def gate(total: int, filtered: int, max_filter_ratio: float = 0.0, checked: DataFrame | None = None) -> None:
    """Fail a load before its commit when the share of filtered rows is above the limit.

    The error shows up to ten different reasons out of ``checked`` rows, redacted, with how often each was given.
    """
    if total and filtered / total > max_filter_ratio:
        raise LoadRejected(f"{filtered} of {total} rows were filtered, limit is {max_filter_ratio}", reason_samples(checked) if checked is not None else None)


def reason_samples(checked: DataFrame, n: int = 10) -> list[str]:
    """The most frequent reasons of bad rows as text, without values."""
    from ..functions.redact import redact_column

    given = checked.where(F.col(REASONS) != "").groupBy(redact_column(F.col(REASONS)).alias("reason")).count()
    return [f"{r['count']} x {r['reason']}" for r in given.orderBy(F.desc("count"), "reason").limit(n).collect()]


def row_bytes(schema: T.StructType) -> Column:
    """Size of a row's values: texts and binaries by length, nested values by their JSON text, others by the width of their type."""
    parts, fixed = [], 0
    for f in schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(col))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.octet_length(F.to_json(F.struct(col))))
        else:
            wide = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.DecimalType: 16}.get(type(f.dataType), 8)
            parts.append(F.when(col.isNotNull(), wide))
    return sum((F.coalesce(p, F.lit(0)).cast("bigint") for p in parts), F.lit(fixed).cast("bigint"))


def load_report(df: DataFrame, spec: TableSpec, where: Column | str | None = None, strict: bool = True) -> DataFrame:
    """Row and byte counts of a load in one aggregate: total, loaded, filtered, unselected (dropped by ``where``)."""
    selected = F.lit(True) if where is None else (F.expr(where) if isinstance(where, str) else where)
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c, t in df.dtypes if "<" not in t]
    size = sum(texts[1:], texts[0]) if texts else F.lit(0)
    marked = df.select("*", F.coalesce(selected, F.lit(False)).alias("_selected"), size.cast("bigint").alias("_bytes"))
    checked = check_rows(marked, spec, strict)
    bad = F.col(REASONS) != ""
    return checked.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("_selected") & ~bad).alias("loaded_rows"),
        F.count_if(F.col("_selected") & bad).alias("filtered_rows"),
        F.count_if(~F.col("_selected")).alias("unselected_rows"),
        F.coalesce(F.sum(F.when(F.col("_selected") & ~bad, F.col("_bytes"))), F.lit(0)).alias("loaded_bytes"),
    )


def conform(df: DataFrame, schema: T.StructType | TableSpec, mode: str = "fail") -> DataFrame:
    """Coerce text to declared types. ``fail`` raises on a value that does not fit or a null in a NOT NULL column;
    ``null`` turns misfits into nulls.

    Date-times with more than six fraction digits are cut to microseconds.
    """
    fields = schema.schema.fields if isinstance(schema, TableSpec) else schema.fields
    given = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in fields:
        if f.name.lower() not in given:
            raise ValueError(f"input has no column {f.name}")
        have = given[f.name.lower()]
        source = F.col(f"`{have.name}`")
        if isinstance(have.dataType, T.StringType) and isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = nested_of_text(source, f.dataType)
        elif have.dataType == f.dataType:
            value = source
        elif mode == "fail" and not isinstance(have.dataType, T.StringType) and not _widens(have.dataType, f.dataType):
            raise ValueError(
                f"column {f.name} is declared {f.dataType.simpleString()} but holds {have.dataType.simpleString()}"
            )
        else:
            value = source.try_cast(f.dataType)
        if mode == "fail":
            misfit = F.raise_error(F.concat(F.lit(f"column {f.name} cannot take "), source.cast("string")))
            if have.dataType != f.dataType:
                value = F.coalesce(value, F.when(source.isNotNull(), misfit.cast(f.dataType)))
            if not f.nullable:
                empty = F.raise_error(F.lit(f"null in the non-nullable column {f.name}"))
                value = F.when(source.isNull(), empty.cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return df.select(*out)


def _widens(have: T.DataType, want: T.DataType) -> bool:
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if isinstance(have, numeric) and isinstance(want, numeric):
        return numeric.index(type(have)) < numeric.index(type(want))
    if type(have) is type(want):
        return True  # decimals of another size: each value is checked
    return isinstance(want, T.StringType) or (isinstance(have, T.TimestampType) and isinstance(want, T.TimestampNTZType))
