"""Column mappings with aggregate functions: ``"page,day,user,users=to_bitmap(user),seen=hll_hash(user)"``.

A mapping is compiled into scalar expressions, which are computed row by row and checked like any other column, and into builders of
sketches, which become partial aggregates per key before the rows meet the table. The raw value of a builder travels as a column of its own.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from typing import Iterable

from pyspark.sql import DataFrame, functions as F

from ..spec import ColumnSpec, TableSpec
from .columns import split_mapping
from .quality import REASONS
from .sketches import BUCKET

SOURCE = "_source_"  # prefix of the column that holds a builder's raw value
_CALL = re.compile(r"(?is)\s*(to_bitmap|hll_hash|bitmap_empty|hll_empty)\s*\((.*)\)\s*")
_KINDS = {"to_bitmap": "bitmap", "bitmap_empty": "bitmap", "hll_hash": "hll", "hll_empty": "hll"}
_TYPES = {"bitmap": "BITMAP", "hll": "HLL"}


@dataclass(frozen=True)
class Builder:
    target: str
    kind: str  # bitmap or hll
    source: str | None  # expression of the value; None: an empty sketch


@dataclass(frozen=True)
class LoadColumns:
    """A compiled mapping: input fields in order, derived scalar columns and builders by target column."""

    fields: tuple[str, ...]
    scalars: tuple[tuple[str, str], ...]
    builders: tuple[Builder, ...]

    @classmethod
    def compile(cls, mapping: str, spec: TableSpec) -> LoadColumns:
        """Raises for builders outside an aggregate table, for targets of another type and for calls inside other expressions."""
        entries = split_mapping(mapping)
        builders, scalars = [], []
        for name, expr in entries:
            if expr is None:
                continue
            call = _CALL.fullmatch(expr)
            if not call or not _balanced(call[2]):
                if re.search(r"(?i)\b(to_bitmap|hll_hash|bitmap_empty|hll_empty)\s*\(", re.sub(r"'[^']*'", "", expr)):
                    raise ValueError(f"{expr.strip()!r}: a sketch is built by one call, not inside another expression")
                scalars.append((name, expr))
                continue
            kind, source = _KINDS[call[1].lower()], call[2].strip()
            if bool(source) == call[1].lower().endswith("_empty"):
                raise ValueError(f"{expr.strip()!r}: wrong number of arguments")
            column = spec.column(name)
            if spec.model != "aggregate" or column.type.upper() != _TYPES[kind]:
                raise ValueError(f"{name}: {call[1]} needs a {_TYPES[kind]} column of an aggregate table")
            if kind == "bitmap" and BUCKET not in spec.keys:
                raise ValueError(f"{spec.name} has no key {BUCKET} for the ranges of its bitmaps; see sketch_table")
            builders.append(Builder(column.name, kind, source or None))
        return cls(tuple(n for n, e in entries if e is None), tuple(scalars), tuple(builders))

    def named(self, df: DataFrame) -> DataFrame:
        """Input columns by the names of the fields: as they are if all are there, else by position."""
        if set(self.fields) <= set(df.columns):
            return df
        if len(self.fields) != len(df.columns):
            raise ValueError(f"mapping names {len(self.fields)} fields, input has {len(df.columns)}")
        return df.toDF(*self.fields)

    def derive(self, df: DataFrame, spec: TableSpec, keep: Iterable[str] = ()) -> DataFrame:
        """Derived columns and builders' values added, fields that neither the table nor ``keep`` has dropped; misfits go to ``_reasons``.

        A bitmap takes whole numbers from 0 on, as numbers or text without a fraction; an HLL takes the text of any value. Null adds nothing.
        """
        out = df.select("*", *[F.expr(e).alias(n) for n, e in self.scalars])
        reasons = [F.nullif(F.col(REASONS), F.lit(""))] if REASONS in df.columns else []
        for b in self.builders:
            raw = F.expr(b.source) if b.source else F.lit(None).cast("bigint")
            if b.kind == "hll":
                out = out.withColumn(SOURCE + b.target, raw.cast("string"))
                continue
            value = raw.try_cast("bigint")
            misfit = raw.isNotNull() & (value.isNull() | (value < 0) | (raw.try_cast("double") != value.cast("double")))
            reasons.append(F.when(misfit, F.concat(F.lit("Value '"), raw.cast("string"), F.lit(f"' does not fit BITMAP of '{b.target}'"))))
            out = out.withColumn(SOURCE + b.target, value)
        if reasons:
            out = out.withColumn(REASONS, F.concat_ws("; ", *reasons))
        known = {n.lower() for n in (*spec.names, *keep)}
        return out.drop(*[f for f in self.fields if f.lower() not in known and f != "__op"])

    @property
    def sources(self) -> set[str]:
        return {SOURCE + b.target for b in self.builders}

    def row_spec(self, spec: TableSpec) -> TableSpec:
        """The table as single rows see it: without sketches and the ranges of bitmaps."""
        built = {b.target for b in self.builders} | ({BUCKET} if self._bitmaps else set())
        return replace(spec, columns=tuple(c for c in spec.columns if c.name not in built), keys=tuple(k for k in spec.keys if k not in built))

    @property
    def _bitmaps(self) -> list[Builder]:
        return [b for b in self.builders if b.kind == "bitmap"]

    def partials(self, rows: DataFrame, spec: TableSpec, aggregates: dict) -> DataFrame:
        """Checked rows as one row per key (and range of a bitmap) with the columns of the table: combined on the map side first.

        With several bitmaps a row counts in the range of each; its other values go with the first.
        """
        keys, bitmaps = [k for k in spec.keys if k != BUCKET or not self._bitmaps], self._bitmaps
        plain = [c for c in spec.values if c not in {b.target for b in self.builders}]
        hlls = [b for b in self.builders if b.kind == "hll"]
        if bitmaps:
            at = lambda b: F.coalesce(F.bitmap_bucket_number(F.col(f"`{SOURCE}{b.target}`")), F.lit(0).cast("bigint"))
            one = lambda i: F.struct(at(bitmaps[i]).alias(BUCKET), *[
                (F.bitmap_bit_position(F.col(f"`{SOURCE}{b.target}`")) if i == k else F.lit(None).cast("bigint")).alias(f"_{k}") for k, b in enumerate(bitmaps)], F.lit(i == 0).alias("_first"))
            pieces = [F.when(F.lit(i == 0) | F.col(f"`{SOURCE}{b.target}`").isNotNull(), one(i)) for i, b in enumerate(bitmaps)]
            rows = rows.select("*", F.explode(F.array_compact(F.array(*pieces))).alias("_piece"))
            first = F.col("_piece._first")
            rows = rows.select(*keys, *[F.when(first, F.col(f"`{c}`")).alias(c) for c in plain], *[F.when(first, F.col(f"`{SOURCE}{b.target}`")).alias(SOURCE + b.target) for b in hlls], "_piece.*")
            keys = [*keys, BUCKET]
        built = {c: aggregates[c](c) for c in plain}
        built |= {b.target: F.when(F.count(SOURCE + b.target) > 0, F.hll_sketch_agg(F.col(SOURCE + b.target))) for b in hlls}
        built |= {b.target: F.when(F.count(f"_{k}") > 0, F.bitmap_construct_agg(f"_{k}")) for k, b in enumerate(bitmaps)}
        return rows.groupBy(*keys).agg(*[v.alias(c) for c, v in built.items()]).select(*spec.names)


def _balanced(text: str) -> bool:
    """Whether no parenthesis of the text closes one before it, so that the call around it is one call."""
    depth = 0
    for c in re.sub(r"'[^']*'", "", text):
        depth += (c == "(") - (c == ")")
        if depth < 0:
            return False
    return depth == 0


def sketch_table(spec: TableSpec) -> TableSpec:
    """An aggregate table with a key for the ranges of its bitmaps, if it has a BITMAP column and no such key."""
    if BUCKET in spec.keys or not any(c.type.upper() == "BITMAP" for c in spec.columns):
        return spec
    keys = [spec.column(k) for k in spec.keys]
    rest = [c for c in spec.columns if c not in keys]
    return replace(spec, columns=(*keys, ColumnSpec(BUCKET, "BIGINT", False), *rest), keys=(*spec.keys, BUCKET))


def aggregate_values(df: DataFrame, spec: TableSpec, by: Iterable[str] | None = None) -> DataFrame:
    """Rows of an aggregate table as values: sketches as distinct counts, other columns merged by their aggregate.

    ``by`` are key columns (default: all but the range of bitmaps). Pieces of one range are united first, so counts of coarser groups are
    exact for bitmaps and within the sketch's error for HLL. Groups without a value count 0.
    """
    from ..store.table import aggregate_of

    keys = [k for k in spec.keys if k != BUCKET]
    by = keys if by is None else list(by)
    unknown = set(by) - set(keys)
    if unknown:
        raise ValueError(f"{sorted(unknown)} are no keys of {spec.name}")
    values = [c for c in spec.columns if c.name not in spec.keys]
    ranged = BUCKET in spec.keys
    if ranged:
        df = df.groupBy(*by, BUCKET).agg(*[aggregate_of(c)(c.name).alias(c.name) for c in values])
    out = []
    for c in values:
        kind = c.type.upper()
        if kind == "BITMAP" and ranged:
            out.append(F.coalesce(F.sum(F.bitmap_count(c.name)), F.lit(0)).alias(c.name))
        elif kind == "HLL":
            out.append(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c.name)), F.lit(0)).alias(c.name))
        else:
            out.append(aggregate_of(c)(c.name).alias(c.name))
    return df.groupBy(*by).agg(*out)
