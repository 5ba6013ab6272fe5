"""Commits bounded by rows and bytes: one micro-batch cut into consecutive loads."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.quality import row_bytes
from ..session import Files
from ..store.table import KeyedTable, _safe

AT = "_at"
MOST_PARTS = 1 << 20


@dataclass(frozen=True)
class Part:
    first: int  # places of the first and last row in the staged order
    last: int
    rows: int
    bytes: int


def cut(staged: DataFrame, max_rows: int | None, max_bytes: int | None) -> list[Part]:
    """Consecutive parts of staged rows (``_at``, ``_bytes``): at most ``max_rows`` rows, and ``max_bytes`` bytes but for the last row.

    ``_at`` holds the range partition in its upper bits. Each partition's rows and bytes are summed, the sums of those before it (one number
    for each partition) are broadcast, and every row finds its part from its own running sums, so no task sees more than its partition.
    """
    slot = F.shiftright(AT, 33)
    sums = staged.groupBy(slot.alias("_slot")).agg(F.count("*").alias("n"), F.sum("_bytes").alias("b")).orderBy("_slot").collect()
    before, n, b = [], 0, 0
    for r in sums:
        before.append((r["_slot"], n, b))
        n, b = n + r["n"], b + r["b"]
    if not n:
        return []
    offsets = staged.sparkSession.createDataFrame(before, "_slot bigint, _n bigint, _b bigint")
    rows = staged.select(AT, "_bytes", slot.alias("_slot"))
    by_rows = F.floor((F.col("_n") + F.col(AT).bitwiseAND((1 << 33) - 1)) / max_rows) if max_rows else F.lit(0)
    by_bytes = F.lit(0)
    if max_bytes:
        rows = rows.selectExpr("*", f"sum(_bytes) OVER (PARTITION BY _slot ORDER BY {AT} ROWS UNBOUNDED PRECEDING) - _bytes AS _running")
        by_bytes = F.floor((F.col("_b") + F.col("_running")) / max_bytes)
    part = (by_rows + by_bytes).cast("bigint")
    found = rows.join(F.broadcast(offsets), "_slot").groupBy(part.alias("part")).agg(F.min(AT), F.max(AT), F.count("*"), F.sum("_bytes")).orderBy("part").collect()
    if len(found) > MOST_PARTS:
        raise ValueError(f"{len(found)} commits for one batch; the limits are too small")
    return [Part(*r[1:]) for r in found]


def in_order(batch: DataFrame, seq: Iterable[str]) -> DataFrame:
    """Rows in the order of ``seq`` (ties: by a hash of the row, so equal input gives an equal order), with their place and size."""
    plain = [f.name for f in batch.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    rows = batch.select("*", tie.alias("_tie"), row_bytes(batch.schema).alias("_bytes"))
    spread = rows.repartitionByRange(*[F.col(f"`{c}`") for c in seq], "_tie").sortWithinPartitions(*[F.col(f"`{c}`") for c in seq], "_tie")
    return spread.drop("_tie").withColumn(AT, F.monotonically_increasing_id())


def load_in_parts(
    table: KeyedTable, batch: DataFrame, seq: Iterable[str] | str, max_rows: int | None = None, max_bytes: int | None = None,
    query_id: str | None = None, batch_id: int | None = None, stream_id: str | None = None, **options,
) -> list[dict]:
    """Load a batch as consecutive commits of at most ``max_rows`` rows and about ``max_bytes`` bytes (see :func:`cut`), in the order of ``seq``.

    The batch is sorted and written once beside the table; each part is a range of that order, read by its files' statistics. The table
    records parts under an id of their own and the batch with the last one: a batch that is delivered again goes on after the last
    recorded part, because equal rows are cut equally. Returns the reports of the parts, skipped ones among them.
    """
    seq = [seq] if isinstance(seq, str) else list(seq)
    spark, named = batch.sparkSession, query_id is not None
    if named and table.finished(query_id, batch_id):
        return [{"skipped": True, "version": table.manifest()["version"]}]
    files = Files(spark, table.path)
    path = f"{table.path}/_parts/{_safe(query_id)}-{batch_id}" if named else f"{table.path}/_parts/once"
    files.delete(path)
    rows = in_order(batch, seq)
    rows.write.parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    try:
        reports, parts = [], cut(staged, max_rows, max_bytes)
        for k, p in enumerate(parts or [Part(0, -1, 0, 0)]):
            own = {}
            if named:
                last = k >= len(parts) - 1
                own = {"query_id": query_id, "batch_id": batch_id} if last else {"query_id": parts_id(query_id), "batch_id": batch_id * MOST_PARTS + k}
            some = staged.where(F.col(AT).between(p.first, p.last)).drop(AT, "_bytes")
            reports.append(table.load(some, seq, stream_id=stream_id, **own, **options))
    finally:
        files.delete(path)
    return reports


def parts_id(query_id: str) -> str:
    """Id under which parts of a batch are recorded that are not its last."""
    return f"{query_id}#parts"
