"""Raw text records to table rows, and custom record functions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.encode import NULL_TEXT, parse_delimiter
from ..operators.columns import split_mapping
from ..operators.quality import REASONS, conform
from ..spec import TableSpec

# fixed values: defaults of a JSON load
JSON_DEFAULTS = {"strip_outer_array": "true", "ignore_json_size": "true"}


def _flag(options: Mapping[str, str], name: str, default: str = "false") -> bool:
    return str(options.get(name, default)).lower() == "true"


def text_struct(names: list[str]) -> str:
    """Type text of a row of text fields."""
    return "struct<" + ",".join(f"`{n.replace('`', '``')}`: string" for n in names) + ">"


def decode_text(
    df: DataFrame, names: list[str], fmt: str, options: Mapping[str, str] | None = None, col: str = "value"
) -> DataFrame:
    """Split records into text fields ``names`` plus ``_reasons`` (non-empty for a record that cannot be read).

    Other columns of ``df`` are kept. CSV is neither quoted nor escaped. A JSON record is an object, or an array of
    objects when ``strip_outer_array`` is on.
    """
    options = dict(options or {})
    keep = [F.col(f"`{c}`") for c in df.columns if c != col]
    good = F.lit("")
    if fmt == "csv":
        sep = parse_delimiter(options.get("column_separator"), "\t")
        parts = F.split(F.col(col), "\\Q" + sep + "\\E", -1)
        fields = df.select(*keep, parts.alias("_p"))
        wrong = F.coalesce(F.size("_p") != len(names), F.lit(True))
        return fields.select(
            *keep,
            *[F.nullif(F.try_element_at("_p", F.lit(i + 1)), F.lit(NULL_TEXT)).alias(n) for i, n in enumerate(names)],
            F.when(wrong, F.format_string("expected %d fields, found %d", F.lit(len(names)), F.size("_p"))).otherwise(good).alias(REASONS),
        )
    if fmt != "json":
        raise ValueError(f"unknown format {fmt}")
    options = {**JSON_DEFAULTS, **options}
    strip = _flag(options, "strip_outer_array") or _flag(options, "wrap_json_as_array")
    row, text = text_struct(names), F.col(col)
    value = F.try_parse_json(text)
    one = F.array(F.try_variant_get(value, "$", row))
    many = F.try_variant_get(value, "$", f"array<{row}>")
    parsed = F.when(F.ltrim(text).startswith("{"), one)
    parsed = parsed.when(F.ltrim(text).startswith("["), many) if strip else parsed
    rows = df.select(*keep, F.explode_outer(parsed).alias("_r"))
    return rows.select(
        *keep,
        *[F.col("_r").getField(n).alias(n) for n in names],
        F.when(F.col("_r").isNull(), "record is not readable JSON").otherwise(good).alias(REASONS),
    )


def decode(
    df: DataFrame,
    schema: T.StructType | TableSpec,
    fmt: str,
    options: Mapping[str, str] | None = None,
    col: str = "value",
    mode: str = "fail",
) -> DataFrame:
    """Raw text records to typed rows; ``options["columns"]`` may name and derive the fields.

    ``fail`` raises on a record or value that cannot be read, ``null`` gives nulls, ``keep`` returns the text fields
    with ``_reasons`` for ``quality.check_rows``.
    """
    options = dict(options or {})
    struct = schema.schema if isinstance(schema, TableSpec) else schema
    mapping = options.get("columns")
    names = [n for n, e in split_mapping(mapping) if e is None] if mapping else struct.names
    rows = decode_text(df.select(col), names, fmt, options, col)
    if mapping:
        reasons = rows.select(REASONS, *names)
        derived = [F.expr(e).alias(n) for n, e in split_mapping(mapping) if e is not None]
        rows = reasons.select(*names, *derived, REASONS)
    if mode == "keep":
        return rows
    if mode == "fail":
        unreadable = F.raise_error(F.col(REASONS)).cast("string")
        first = F.col(f"`{rows.columns[0]}`")
        rows = rows.withColumn(rows.columns[0], F.when(F.col(REASONS) != "", unreadable).otherwise(first))
    return conform(rows.drop(REASONS), struct, mode)


def map_records(
    df: DataFrame, fn: Callable, schema: T.StructType | str, arrow: bool = False
) -> DataFrame:
    """Custom row builder: ``fn`` gets an iterator of pandas (or Arrow) batches and yields batches of ``schema``."""
    return df.mapInArrow(fn, schema) if arrow else df.mapInPandas(fn, schema)


ADDRESSED = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("database", "table", "row")]))


def custom_records(df: DataFrame, fn: Callable, columns: Sequence[str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Records to addressed rows by a function of one's own: any number of rows for each record, for ``streaming.route``.

    ``fn`` gets Arrow batches of ``columns`` (default: all but ``keep``) and returns for each batch one list of ``(database, table, row)`` per
    record, as an Arrow array of lists of structs or as Python lists of tuples. A record with an empty list, or a null, becomes one row without an address,
    which ``route`` skips and counts. ``keep`` columns (``seq``, the place in a file) are not shown to ``fn``; with ``seq`` the rows of one
    record follow each other in their order. Works on streams.
    """
    keep = [c for c in keep if c in df.columns]
    columns = list(columns or [c for c in df.columns if c not in keep])
    arrow = pa.list_(pa.struct([(c, pa.string()) for c in ("database", "table", "row")]))
    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("_rows", ADDRESSED)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = fn(b.select(columns))
            if not isinstance(made, (pa.Array, pa.ChunkedArray)):
                made = pa.array([None if rows is None else [dict(zip(("database", "table", "row"), r)) for r in rows] for rows in made], arrow)
            made = made.combine_chunks() if isinstance(made, pa.ChunkedArray) else made
            if len(made) != b.num_rows:
                raise ValueError(f"{len(made)} lists for {b.num_rows} records")
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in keep], made.cast(arrow)], names=[*keep, "_rows"])

    rows = df.select(*keep, *[c for c in columns if c not in keep]).mapInArrow(each, schema)
    out = rows.select(*keep, F.posexplode_outer("_rows").alias("_pos", "_row")).select(*keep, "_pos", "_row.*")
    if "seq" in keep:
        out = out.withColumn("seq", F.struct("seq", "_pos"))
    return out.drop("_pos")


def address_records(df: DataFrame, database: Column | str, table: Column | str, row: Column) -> DataFrame:
    """Records with a target address, for ``streaming.route``."""
    lit = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(lit(database).alias("database"), lit(table).alias("table"), row.alias("row"))
