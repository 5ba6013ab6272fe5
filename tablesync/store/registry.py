"""Small registry of tables: folders ``<root>/<database>/<table>`` that hold a manifest."""

from __future__ import annotations

import re
from dataclasses import replace
from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import Files
from ..sources.scan import _conditions, _known
from ..spec import ColumnSpec, TableSpec, validate
from ..types import split_type
from .table import KeyedTable


_EQUAL = re.compile(r"(?i)\s*`?(\w+)`?\s*(?:=\s*(?P<one>-?\d+|'[^']*')|in\s*\((?P<some>[^()]*)\))\s*")
_VALUE = re.compile(r"\s*(-?\d+|'[^']*')\s*(?:,|$)")


def wanted_keys(spec: TableSpec, conditions: Iterable) -> dict[str, list] | None:
    """Values of all key columns if text conditions joined by AND fix them (``k = 7``, ``k IN ('a', 'b')``), else None.

    Literals must have the key's own type: whole numbers for an integer key, quoted text for a text key. Others, which a comparison
    would convert (``k = 7`` finds the texts '7' and '07'), and other conditions are left to the scan.
    """
    found: dict[str, list] = {}
    if not spec.has_primary_key:
        return None
    integer = {k: isinstance(spec.column(k).spark, T.IntegralType) for k in spec.keys}
    if not all(integer[k] or isinstance(spec.column(k).spark, T.StringType) and split_type(spec.column(k).type)[0] != "LARGEINT" for k in spec.keys):
        return None
    for text in (c for c in conditions if isinstance(c, str)):
        if re.search(r"(?i)\b(or|not|case|between)\b", text):
            continue
        for part in re.split(r"(?i)\s+and\s+", text):
            m = _EQUAL.fullmatch(part)
            key = next((k for k in spec.keys if m and k.lower() == m[1].lower()), None)
            if key and key not in found:
                values = [m["one"]] if m["one"] else [v[1] for v in _VALUE.finditer(m["some"])]
                of_key_type = all((v[0] != "'") == integer[key] and (v[0] == "'" or abs(int(v)) < 1 << 63) for v in values)
                if values and of_key_type and (m["one"] or "".join(values) == re.sub(r"[\s,]", "", m["some"])):
                    found[key] = [v[1:-1] if v[0] == "'" else int(v) for v in values]
    return found if set(found) == set(spec.keys) else None


class Registry:
    """``source_options`` and ``load_options`` are defaults; the options of a table, then those of a call, go over them."""

    def __init__(
        self, spark: SparkSession, root: str, source_options: Mapping | None = None, load_options: Mapping | None = None
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self._files = Files(spark, root)
        self._source, self._load = dict(source_options or {}), dict(load_options or {})

    # databases
    def databases(self) -> list[str]:
        return [n for n in self._files.names(self.root) if not n.startswith(("_", "."))]

    def has_database(self, database: str) -> bool:
        return self._files.exists(f"{self.root}/{database}")

    def create_database(self, database: str, if_not_exists: bool = False) -> None:
        if self.has_database(database) and not if_not_exists:
            raise ValueError(f"database {database} exists")
        self._files.mkdirs(f"{self.root}/{database}")

    # tables
    def tables(self, database: str) -> list[str]:
        if not self.has_database(database):
            raise ValueError(f"no database {database}")
        return [n for n in self._files.names(f"{self.root}/{database}") if self.exists(database, n)]

    def exists(self, database: str, table: str) -> bool:
        return self._files.exists(f"{self.root}/{database}/{table}/_manifest")

    def table(self, database: str, table: str) -> KeyedTable:
        if not self.exists(database, table):
            raise ValueError(f"no table {database}.{table}")
        return KeyedTable(self.spark, f"{self.root}/{database}/{table}")

    def create(self, spec: TableSpec, if_not_exists: bool = False) -> KeyedTable:
        """Create an empty keyed table; key columns come first."""
        if not self.has_database(spec.database):
            raise ValueError(f"no database {spec.database}")
        if not spec.keys:
            raise ValueError(f"table {spec.name} has no primary key")
        first = [spec.column(k) for k in spec.keys]
        columns = [replace(c, nullable=False) for c in first] + [c for c in spec.columns if c not in first]
        return KeyedTable.create(
            self.spark, f"{self.root}/{spec.database}/{spec.table}", spec.with_columns(columns), if_not_exists
        )

    def ensure_tables(self, specs: Iterable[TableSpec]) -> None:
        """Create the databases and tables that are missing."""
        for spec in specs:
            self.create_database(spec.database, if_not_exists=True)
            self.create(spec, if_not_exists=True)

    def drop(self, database: str, table: str, if_exists: bool = False) -> None:
        if not self.exists(database, table):
            if if_exists:
                return
            raise ValueError(f"no table {database}.{table}")
        self._files.delete(f"{self.root}/{database}/{table}")

    def describe(self, database: str, table: str) -> DataFrame:
        """One row per column: name, position, type, size, digits, nullable, default, key position, comment, model."""
        spec = self.table(database, table).spec
        rows = []
        for i, c in enumerate(spec.columns):
            name, size, digits = split_type(c.type)
            key = spec.keys.index(c.name) + 1 if c.name in spec.keys else None
            rows.append((c.name, i + 1, name if "<" not in c.type else c.type, size, digits, c.nullable, c.default, key, c.comment, spec.model))
        return self.spark.createDataFrame(
            rows,
            "column_name string, position int, type string, size int, digits int, nullable boolean, default string, "
            "key_position int, comment string, model string",
        )

    def evolve(self, database: str, table: str, add: Iterable[ColumnSpec] = (), drop: Iterable[str] = ()) -> None:
        self.table(database, table).evolve(add, drop)

    # select and insert-select
    def read(self, database: str, table: str, columns=None, where=None, limit: int | None = None, **options) -> DataFrame:
        t = self.table(database, table)
        merged = {**self._source, **t.spec.options.get("source", {}), **options}
        columns = columns or [c.strip() for c in merged.get("scan.columns", "").split(",") if c.strip()] or None
        conditions = _conditions(where if where is not None else merged.get("scan.filter"))
        df = t.read(keys=wanted_keys(t.spec, conditions))
        for condition in conditions:
            df = df.where(condition)
        df = df.select(*_known(df, columns)) if columns else df
        return df if limit is None else df.limit(limit)

    def apply(self, database: str, table: str, df: DataFrame, declared_keys: Iterable[str] | None = None, **options) -> dict:
        """Insert-select or change-log load into a table.

        With ``declared_keys`` the input's schema (columns of the table only) is checked against the table first.
        """
        t = self.table(database, table)
        if declared_keys is not None:
            known = {n.lower() for n in t.spec.names}
            validate(T.StructType([f for f in df.schema.fields if f.name.lower() in known]), t.spec, declared_keys)
        return t.load(df, **{**self._load, **t.spec.options.get("load", {}), **options})
