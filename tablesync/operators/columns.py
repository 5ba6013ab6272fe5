"""Column mapping of a load: ``"a,b,c=expr(b)"`` names the input fields in order and derives further columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

_SKETCH = re.compile(r"^\s*(to_bitmap|hll_hash)\s*\(\s*`?(\w+)`?\s*\)\s*$", re.I)


def split_mapping(text: str) -> list[tuple[str, str | None]]:
    """Split at commas outside parentheses and quotes; each part is a field name or ``target=expression``."""
    parts, depth, quote, start = [], 0, None, 0
    for i, ch in enumerate(text):
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        elif ch == "," and depth == 0:
            parts.append(text[start:i])
            start = i + 1
    parts.append(text[start:])
    out = []
    for part in parts:
        m = re.match(r"^\s*`?(\w+)`?\s*(?:=(?!=)\s*(.*))?$", part, re.S)
        if not m:
            raise ValueError(f"bad column mapping: {part.strip()!r}")
        out.append((m.group(1), m.group(2).strip() if m.group(2) else None))
    return out


def map_columns(df: DataFrame, mapping: str) -> DataFrame:
    """Rename the input fields by position and add the derived columns.

    ``to_bitmap(x)`` and ``hll_hash(x)`` keep the raw value under the target name; the sketch is built when the load is
    rolled up (see :func:`sketch_columns` and ``operators.sketches``).
    """
    entries = split_mapping(mapping)
    fields = [name for name, expr in entries if expr is None]
    if len(fields) != len(df.columns):
        raise ValueError(f"mapping names {len(fields)} fields, input has {len(df.columns)}")
    named = df.toDF(*fields)
    derived = []
    for name, expr in entries:
        if expr is not None:
            sketch = _SKETCH.match(expr)
            derived.append((F.col(sketch.group(2)) if sketch else F.expr(expr)).alias(name))
    return named.select("*", *derived) if derived else named


def sketch_columns(mapping: str) -> dict[str, tuple[str, str]]:
    """Targets of a mapping that hold sketches: name -> (``bitmap`` or ``hll``, source field)."""
    out = {}
    for name, expr in split_mapping(mapping):
        m = _SKETCH.match(expr or "")
        if m:
            out[name] = ("bitmap" if m.group(1).lower() == "to_bitmap" else "hll", m.group(2))
    return out
