"""What the planner did: filters that reached the file reader, columns read, shuffles."""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import Column, DataFrame


def _scans(df: DataFrame) -> list[dict[str, str]]:
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "FileSourceScan" in leaf.getClass().getSimpleName():
            meta = leaf.metadata()
            out.append({k: meta.apply(k) for k in ("PushedFilters", "DataFilters", "ReadSchema") if meta.contains(k)})
    return out


def _entries(text: str) -> list[str]:
    """Top-level entries of ``[a(b, c), d]``."""
    parts, depth, start, body = [], 0, 0, text.strip()[1:-1]
    for i, ch in enumerate(body):
        depth += (ch in "([{") - (ch in ")]}")
        if ch == "," and depth == 0:
            parts.append(body[start:i].strip())
            start = i + 1
    return [p for p in parts + [body[start:].strip()] if p]


def pushed_filters(df: DataFrame) -> list[str]:
    """Filters the file readers of a plan received."""
    return [p for scan in _scans(df) for p in _entries(scan.get("PushedFilters", "[]"))]


def read_columns(df: DataFrame) -> list[str]:
    """Columns the file readers of a plan load."""
    return [c for scan in _scans(df) for c in re.findall(r"[<,]([^:,<>]+):", scan.get("ReadSchema", ""))]


def split_filters(df: DataFrame, predicates: Iterable[Column | str]) -> tuple[list, list]:
    """Which predicates reach the file reader as a whole and which stay above the scan, in part or in full."""
    pushed, residual = [], []
    for p in predicates:
        scans = _scans(df.where(p))
        whole = bool(scans) and all(
            _entries(s.get("PushedFilters", "[]"))
            and len(_entries(s["PushedFilters"])) == len(_entries(s.get("DataFilters", "[]")))
            for s in scans
        )
        (pushed if whole else residual).append(p)
    return pushed, residual


def shuffles(df: DataFrame) -> list[str]:
    """Partitionings of all exchanges in the physical plan, broadcasts included."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?:BroadcastExchange|Exchange) (\w+)", text)
