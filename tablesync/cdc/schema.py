"""Source database metadata to table descriptions."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..spec import ColumnSpec, TableSpec
from ..types import source_type_column


def select_tables(
    tables: DataFrame, include: str | None = None, exclude: str | None = None, name: str = "table_name",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Source tables to sync: the whole name matches ``include`` and does not match ``exclude``.

    With ``keys`` (one row per primary key column) tables without a primary key are left out.
    """
    whole = lambda pattern: F.col(name).rlike(f"^(?:{pattern})$")
    if include is not None:
        tables = tables.where(whole(include))
    if exclude is not None:
        tables = tables.where(~whole(exclude))
    if keys is not None:
        tables = tables.join(keys.select(name).distinct(), name, "left_semi")
    return tables


def target_name(name: Column, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix or ""), name, F.lit(suffix or ""))


def map_source_columns(columns: DataFrame) -> DataFrame:
    """Column metadata rows with the table type in ``type`` (needs ``type_name``, ``column_size``, ``decimal_digits``)."""
    return columns.withColumn("type", source_type_column(F.col("type_name"), F.col("column_size"), F.col("decimal_digits")))


def spec_rows(columns: DataFrame, keys: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Columns of the source tables that are synced, one row each: those of ``columns`` with ``type`` (of the target) and ``key_seq`` (null: no key).

    Tables without a key are left out. :func:`infer_specs` turns the rows of a catalog into descriptions.
    """
    by = ["table_schema", "table_name"]
    chosen = map_source_columns(select_tables(columns, include, exclude)).join(keys.select(*by).distinct(), by, "left_semi")
    return chosen.join(keys.select(*by, "column_name", "key_seq"), [*by, "column_name"], "left")


def infer_specs(
    columns: DataFrame,
    keys: DataFrame,
    database: str,
    include: str | None = None,
    exclude: str | None = None,
    prefix: str = "",
    suffix: str = "",
    props: dict | None = None,
    buckets: int | Mapping[tuple[str, str], int] = 16,
) -> dict[tuple[str, str], TableSpec]:
    """Target tables for a source database, by (source database, source table).

    ``columns``: table_schema, table_name, column_name, ordinal_position, type_name, column_size, decimal_digits,
    nullable (0/1), remarks. ``keys``: table_schema, table_name, column_name, key_seq. The rows are catalog metadata, one
    per column of the source database, grouped per table by Spark. ``buckets`` may be given per (source database, source table):
    a bucket is the unit of rewriting, so choose as many as keep it at a few GB. Source types of dates and times are kept in the
    option ``temporals`` as the encodings a change feed has for them.
    """
    by = ["table_schema", "table_name"]
    fields = ["ordinal_position", "column_name", "type", "nullable", "remarks", "type_name", "decimal_digits", "key_seq"]
    cols = spec_rows(columns, keys, include, exclude).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("cols"))
    specs = {}
    for r in cols.toLocalIterator():
        pk = [c["column_name"] for c in sorted((c for c in r["cols"] if c["key_seq"] is not None), key=lambda c: c["key_seq"])]
        ordered = sorted(r["cols"], key=lambda c: (pk.index(c["column_name"]) if c["column_name"] in pk else len(pk)))
        specs[(r["table_schema"], r["table_name"])] = TableSpec(
            database,
            f"{prefix or ''}{r['table_name']}{suffix or ''}",
            tuple(
                ColumnSpec(c["column_name"], c["type"], bool(c["nullable"]) and c["column_name"] not in pk, None, c["remarks"])
                for c in ordered
            ),
            keys=tuple(pk),
            props=dict(props or {}),
            buckets=buckets.get((r["table_schema"], r["table_name"]), 16) if isinstance(buckets, Mapping) else buckets,
            options={"temporals": t} if (t := {c["column_name"]: e for c in ordered if (e := feed_encoding(c["type_name"], c["decimal_digits"]))}) else {},
        )
    if not specs:
        raise ValueError("no tables to be synchronised")
    return specs


def feed_encoding(type_name: str, digits: int | None) -> str | None:
    """Encoding of a source type in a change feed: date-times of up to three digits are milliseconds, of more microseconds."""
    name = type_name.upper().split("(")[0].strip()
    if name == "DATETIME":
        return "datetime_ms" if (digits or 0) <= 3 else "datetime"
    return {"DATE": "date", "TIME": "time", "TIMESTAMP": "timestamp"}.get(name)


def read_metadata(spark: SparkSession, url: str, database: str, **options) -> tuple[DataFrame, DataFrame]:
    """Column and key metadata of a source database through ``information_schema`` over JDBC."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    columns = reader.option(
        "query",
        "select table_schema, table_name, column_name, ordinal_position, column_type, "
        "coalesce(character_maximum_length, numeric_precision) column_size, numeric_scale decimal_digits, "
        f"case is_nullable when 'YES' then 1 else 0 end nullable, column_comment remarks "
        f"from information_schema.columns where table_schema = '{database}'",
    ).load()
    keys = reader.option(
        "query",
        "select table_schema, table_name, column_name, ordinal_position key_seq from information_schema.key_column_usage "
        f"where constraint_name = 'PRIMARY' and table_schema = '{database}'",
    ).load()
    type_name = F.regexp_replace(F.col("column_type"), r"\s*\([^)]*\)", "")
    return columns.withColumn("type_name", type_name).drop("column_type"), keys
