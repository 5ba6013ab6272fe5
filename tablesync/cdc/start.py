"""Where a synchronisation starts: positions in a change feed, and a bulk snapshot that is joined to the feed at one."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.temporal import ZONE
from ..operators.quality import REASONS
from ..spec import OP, TableSpec
from ..store.registry import Registry
from ..streaming.route import in_parallel
from .debezium import ORDER, debezium_to_changes, parse_debezium

PHASE = "_phase"  # 0: a row of the snapshot, 1: a change of the log


@dataclass(frozen=True)
class Position:
    """A place in a feed: a time in milliseconds, or a log file and a place in it. ``after`` leaves the events at the place itself out.

    Files of one log differ in the number at their end, which orders them.
    """

    ts_ms: int | None = None
    file: str | None = None
    pos: int | None = None
    after: bool = False

    def __post_init__(self) -> None:
        if (self.ts_ms is None) == (self.file is None):
            raise ValueError("a position is a time, or a file and a place in it")
        if self.file is not None and not re.search(r"\d+$", self.file):
            raise ValueError(f"{self.file} has no number at its end")

    @classmethod
    def of(cls, start: str | Mapping | Position | None) -> Position | None:
        """``initial`` and ``earliest`` (or nothing) start at the beginning, a mapping has the fields of a position."""
        if start is None or isinstance(start, Position):
            return start
        if isinstance(start, str):
            if start in ("initial", "earliest"):
                return None
            raise ValueError(f"a job cannot start at {start!r}; {'use the reader options of start_position' if start == 'latest' else 'name a position'}")
        return cls(**start)

    def passed(self) -> Column:
        """Whether a parsed event lies before the position; null where the event has none."""
        if self.ts_ms is not None:
            have, want = F.coalesce("_src_ts", "_ts"), F.lit(self.ts_ms)
        else:
            number = F.regexp_extract("_src_file", r"([0-9]+)$", 1).try_cast("bigint")
            have = F.struct(number.alias("n"), F.col("_src_pos").alias("p"))
            have = F.when(number.isNotNull() & F.col("_src_pos").isNotNull(), have)
            want = F.struct(F.lit(int(re.search(r"\d+$", self.file)[0])).cast("bigint").alias("n"), F.lit(self.pos or 0).cast("bigint").alias("p"))
        return have <= want if self.after else have < want

    def since(self, events: DataFrame) -> DataFrame:
        """Parsed events from the position on; events that have no such position stay."""
        return events.where(~F.coalesce(self.passed(), F.lit(False)))

    def until(self, events: DataFrame) -> DataFrame:
        """Parsed events up to and with the position; events that have no such position are left out."""
        return events.where(F.coalesce(replace(self, after=True).passed(), F.lit(False)))

    def skip(self, feed: DataFrame) -> DataFrame:
        """A raw feed without rows before the position, if it has columns ``ts_ms`` or ``file`` beside the event: plain comparisons, which
        the file reader answers from the statistics of files and row groups. The events themselves are judged by :meth:`since`."""
        have = set(feed.columns)
        if self.ts_ms is not None and "ts_ms" in have:
            return feed.where(F.col("ts_ms").isNull() | (F.col("ts_ms") >= self.ts_ms))
        if self.file is not None and "file" in have:
            digits = re.search(r"\d+$", self.file)[0]
            base = self.file[: -len(digits)]
            # names of the next length come later, whatever their first digit; where numbers aren't padded, longer ones too
            longer = [F.col("file").between(base + "1" + "0" * n, base + "9" * (n + 1)) for n in range(len(digits), 19)]
            later = F.col("file").between(self.file, base + "9" * len(digits))
            for x in longer:
                later = later | x
            return feed.where(F.col("file").isNull() | later)
        return feed


def snapshot_changes(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of a source table as load rows: the table's columns as text, before every change of the log."""
    given = {c.lower(): c for c in rows.columns}

    def text(name: str) -> Column:
        if name.lower() not in given:
            return F.lit(None).cast("string")
        col, kind = F.col(f"`{given[name.lower()]}`"), rows.schema[given[name.lower()]].dataType
        return F.to_json(col) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else col.cast("string")

    return rows.select(*[text(n).alias(n) for n in spec.names], F.lit(0).alias(OP), F.lit(0).alias("_sub"), F.lit("").alias(REASONS))


def load_snapshot(
    registry: Registry,
    specs: Mapping[tuple[str, str], TableSpec],
    snapshot: Mapping[tuple[str, str], DataFrame],
    log: DataFrame,
    low: Position | Mapping,
    high: Position | Mapping,
    name: str = "snapshot",
    col: str = "value",
    ignore_update_before: bool = True,
    temporals: Mapping[tuple[str, str], Mapping[str, str]] | None = None,
    zone: str = ZONE,
    width: int = 8,
    **load_options,
) -> dict[str, dict]:
    """Load a bulk snapshot so that each table is at position ``high`` of its log, in one commit per table.

    ``snapshot`` has the rows of source tables, read in bulk while the log went on: some before, some after changes that the log has between
    ``low``, its position before the first row was read, and ``high``, the one after the last. Those changes of ``log`` (a DataFrame of
    the feed) are put over the snapshot's rows by key in the order of the log, so a row that changed meanwhile ends as the log
    left it, whether the snapshot saw the change or not. Changes up to ``low`` are in the snapshot already and not read again.
    Tables that the snapshot lacks get their changes only. The load is recorded under ``name``: run again, it does nothing. Go on with
    ``sync_database(..., start=Position(..., after=True))`` at ``high``.
    """
    low, high = (replace(Position.of(p), after=True) for p in (low, high))
    temporals = temporals or {}
    events = high.until(low.since(parse_debezium(low.skip(log).select(col), col))).withColumn("_in", F.monotonically_increasing_id())
    at = [PHASE, *ORDER, "_in"]

    def load(source: tuple[str, str], spec: TableSpec) -> dict:
        mine = events.where((F.col("src_db") == source[0]) & (F.col("src_table") == source[1])).withColumn(PHASE, F.lit(1))
        encoded = temporals.get((spec.database, spec.table), spec.options.get("temporals", {}))
        rows = debezium_to_changes(mine, spec, ignore_update_before, keep=at, temporals=encoded, zone=zone)
        if source in snapshot:
            first = [F.lit(0).alias(PHASE), *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in at[1:]]]
            rows = snapshot_changes(snapshot[source], spec).select("*", *first).unionByName(rows)
        return registry.table(spec.database, spec.table).load(rows, at, query_id=name, batch_id=0, **load_options)

    registry.ensure_tables(specs.values())
    return in_parallel({spec.name: (lambda s=source, t=spec: load(s, t)) for source, spec in specs.items()}, width)
