"""Debezium change events as columns."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.temporal import ZONE, encoded_text
from ..operators.changes import expand_updates
from ..operators.quality import NO_IMAGE, REASONS
from ..sources.records import text_struct
from ..spec import OP, TableSpec

ENVELOPE = (
    "struct<op: string, before: variant, after: variant, historyRecord: string, ts_ms: bigint, source: struct<db: string, "
    "schema: string, table: string, ts_ms: bigint, file: string, pos: bigint, row: bigint>>"
)
OPS = ("r", "c", "u", "d")  # fixed values: snapshot read, create, update, delete
ORDER = ["_src_ts", "_src_file", "_src_pos", "_src_row", "_ts"]


def parse_debezium(df: DataFrame, col: str = "value") -> DataFrame:
    """Envelope columns of JSON change events, other columns kept.

    Adds ``op``, ``before`` and ``after`` (VARIANT), ``ddl``, ``src_db`` (the schema name where the source has one),
    ``src_table`` and the position columns :data:`ORDER`. Images stay VARIANT until a table's columns are known: the text
    is parsed once, wide tables are read in one go, and numbers keep their digits (up to 38), which text parsing through
    doubles would not.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c != col]
    # one conversion per event, inside an explode so that later filters are not pushed below it
    e = F.col("_e")
    parsed = df.select(*keep, F.explode(F.array(F.try_variant_get(F.try_parse_json(F.col(col)), "$", ENVELOPE))).alias("_e"))
    return parsed.select(
        *keep,
        e.op.alias("op"),
        e.before.alias("before"),
        e.after.alias("after"),
        F.get_json_object(e.historyRecord, "$.ddl").alias("ddl"),
        F.coalesce(e.source.schema, e.source.db).alias("src_db"),
        e.source.table.alias("src_table"),
        e.source.ts_ms.alias("_src_ts"),
        e.source.file.alias("_src_file"),
        e.source.pos.alias("_src_pos"),
        e.source.row.alias("_src_row"),
        e.ts_ms.alias("_ts"),
    )


def debezium_to_changes(
    events: DataFrame,
    spec: TableSpec,
    ignore_update_before: bool = True,
    keep: Iterable[str] = (),
    since: dict[str, Column] | None = None,
    temporals: Mapping[str, str] | None = None,
    zone: str = ZONE,
) -> DataFrame:
    """Parsed events of one table to load rows: the table's columns as text, ``__op``, ``_sub``, ``_reasons``, ``keep``.

    ``r``, ``c`` and ``u`` give the after image as upsert, ``d`` the before image as delete; other events are dropped.
    ``since`` gives per column a condition under which an event's value counts (a column re-created inside a batch).
    ``temporals`` gives the encoding of temporal columns, ``zone`` the zone in which instants are shown.
    """
    names = spec.names
    # images are read inside the explode: once per row, and no later filter is pushed below it
    image = text_struct(names)
    read = lambda col: F.try_variant_get(col, "$", image)
    rows = expand_updates(events, "before", "after", F.col("op"), ignore_update_before, read)
    since = since or {}
    values = []
    for n in names:
        v = F.col("_row").getField(n)
        v = encoded_text(v, temporals[n], zone) if temporals and n in temporals else v
        values.append((F.when(since[n], v) if n in since else v).alias(n))
    reasons = F.when(F.col("_row").isNull(), NO_IMAGE).otherwise("")
    return rows.select(*keep, *values, OP, "_sub", reasons.alias(REASONS))


def invalid_events(events: DataFrame) -> DataFrame:
    """Events that are neither a row change nor a DDL statement; they are dropped and should be counted."""
    return events.where(~F.coalesce(F.col("op").isin(*OPS), F.lit(False)) & (F.col("op").isNotNull() | F.col("ddl").isNull()))
