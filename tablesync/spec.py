"""Table description kept beside the data: columns, keys, model, buckets, options."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any, Iterable

from pyspark.sql import types as T

from .types import accepts, spark_type, table_type

OP = "__op"  # load column: 0 upsert, 1 delete
MODELS = ("duplicate", "aggregate", "unique", "primary")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    default: str | None = None
    comment: str | None = None
    aggregate: str | None = None  # how an aggregate table merges values: sum, min, max, bitmap_union, hll_union

    @property
    def spark(self) -> T.DataType:
        return spark_type(self.type)


@dataclass(frozen=True)
class TableSpec:
    database: str
    table: str
    columns: tuple[ColumnSpec, ...]
    model: str = "primary"
    keys: tuple[str, ...] = ()
    buckets: int = 16
    props: dict[str, str] = field(default_factory=dict)
    comment: str | None = None
    options: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.model not in MODELS:
            raise ValueError(f"unknown table model {self.model}")
        names = [c.name.lower() for c in self.columns]
        if len(set(names)) != len(names):
            raise ValueError("duplicate column name")
        if self.model == "primary" and not self.keys:
            raise ValueError("a primary key table needs key columns")
        for k in self.keys:
            self.column(k)

    @classmethod
    def from_schema(cls, database: str, table: str, schema: T.StructType, keys: Iterable[str] = (), **kw) -> TableSpec:
        """Describe a table by a DataFrame schema; key columns move to the front and become NOT NULL."""
        keys = tuple(keys)
        by_name = {f.name: f for f in schema.fields}
        ordered = [by_name[k] for k in keys] + [f for f in schema.fields if f.name not in keys]
        cols = tuple(
            ColumnSpec(
                f.name,
                f.metadata.get("type") or table_type(f.dataType),
                f.nullable and f.name not in keys,
                f.metadata.get("default"),
                f.metadata.get("comment"),
            )
            for f in ordered
        )
        kw.setdefault("model", "primary" if keys else "duplicate")
        return cls(database, table, cols, keys=keys, **kw)

    @property
    def name(self) -> str:
        return f"{self.database}.{self.table}"

    @property
    def has_primary_key(self) -> bool:
        return self.model == "primary"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def values(self) -> list[str]:
        return [c.name for c in self.columns if c.name not in self.keys]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark, c.nullable) for c in self.columns])

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        raise ValueError(f"table {self.name} has no column {name}")

    def with_columns(self, columns: Iterable[ColumnSpec]) -> TableSpec:
        return replace(self, columns=tuple(columns))

    def to_dict(self) -> dict:
        return {
            "database": self.database, "table": self.table, "model": self.model, "keys": list(self.keys),
            "buckets": self.buckets, "props": self.props, "comment": self.comment, "options": self.options,
            "columns": [vars(c) for c in self.columns],
        }

    @classmethod
    def from_dict(cls, d: dict) -> TableSpec:
        d = dict(d)
        d["columns"] = tuple(ColumnSpec(**c) for c in d["columns"])
        d["keys"] = tuple(d["keys"])
        return cls(**d)


def validate(schema: T.StructType, spec: TableSpec, keys: Iterable[str] | None = None, mapped: bool = False) -> None:
    """Check an input schema against a table before any job runs.

    Names are compared without case. ``mapped`` says that a ``columns`` mapping is given, which skips the column check.
    """
    declared = {k.lower() for k in keys or ()}
    if spec.has_primary_key:
        if not declared:
            raise ValueError(f"primary keys of {spec.name} are not declared on the input")
        if declared != {k.lower() for k in spec.keys}:
            raise ValueError(f"primary keys {sorted(declared)} differ from those of {spec.name}: {list(spec.keys)}")
    if mapped:
        return
    for f in schema.fields:
        if f.name == OP:
            continue
        column = spec.column(f.name)
        if not accepts(column.type, f.dataType):
            raise ValueError(f"column {f.name}: input type {f.dataType.simpleString()} does not fit {column.type}")


def is_aligned(schema: T.StructType, spec: TableSpec) -> bool:
    """Same columns in the same order, and no primary key."""
    given = [f.name.lower() for f in schema.fields]
    return not spec.has_primary_key and given == [n.lower() for n in spec.names]


def column_list(schema: T.StructType, spec: TableSpec, fmt: str = "csv", auto_json: bool = True) -> str | None:
    """Backticked column list a load needs, or None where names are not needed.

    Aligned CSV needs none. JSON carries its own names, except on a keyed table without automatic projection.
    """
    if fmt == "csv":
        needed = not is_aligned(schema, spec)
    else:
        needed = spec.has_primary_key and not auto_json
    if not needed:
        return None
    names = [f.name for f in schema.fields if f.name != OP] + ([OP] if spec.has_primary_key else [])
    return ",".join("`" + n.strip().replace("`", "") + "`" for n in names)
