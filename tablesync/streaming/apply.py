"""Streaming writes into keyed tables."""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..store.table import KeyedTable
from .parts import load_in_parts, parts_id


STREAM_ID = "sql.streaming.queryId"  # fixed value: local property of a micro-batch; the id that its checkpoint keeps


def start_query(
    stream: DataFrame, on_batch: Callable[[DataFrame, int, str], None], checkpoint: str, trigger: str = "availableNow",
    name: str | None = None,
) -> StreamingQuery:
    """``trigger``: ``availableNow`` drains the input and stops; anything else is an interval such as ``10 seconds``.

    ``on_batch`` gets the rows, the batch number and the stream's id. The id belongs to the checkpoint: restarts and
    restored copies of a checkpoint have the same one, any other stream has another.
    """

    def numbered(batch: DataFrame, batch_id: int) -> None:
        on_batch(batch, batch_id, batch.sparkSession.sparkContext.getLocalProperty(STREAM_ID))

    writer = stream.writeStream.foreachBatch(numbered).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    when = {"availableNow": True} if trigger == "availableNow" else {"processingTime": trigger}
    return writer.trigger(**when).start()


ARRIVAL = "_arrival"


def with_arrival(stream: DataFrame) -> DataFrame:
    """Adds where a row of a file source came from, as an order: the file's time, its path, the place of the part read.

    Inside such a part rows keep their order. Raises for other sources, which need a position column of their own.
    """
    m = "_metadata"
    try:
        return stream.select("*", F.struct(f"{m}.file_modification_time", f"{m}.file_path", f"{m}.file_block_start").alias(ARRIVAL))
    except AnalysisException:
        raise ValueError("rows of this source have no order between batches' tasks; name a position column") from None


def admission(max_files: int | None = None, max_bytes: int | None = None) -> dict[str, str]:
    """Options of a file stream that bound one micro-batch, i.e. one commit."""
    options = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    return {k: str(v) for k, v in options.items() if v is not None}


def start_position(start: str, source: str = "kafka", offset: str | int | None = None) -> dict[str, str]:
    """Source options for a start position: initial, earliest, latest, offset, timestamp.

    ``initial`` reads the snapshot and then the changes, which for a stored feed is its beginning. File streams know
    ``timestamp`` (``modifiedAfter``) beside the beginning.
    """
    if source == "kafka":
        if start in ("initial", "earliest"):
            return {"startingOffsets": "earliest"}
        if start == "latest":
            return {"startingOffsets": "latest"}
        if start == "offset":
            return {"startingOffsets": str(offset)}
        if start == "timestamp":
            return {"startingTimestamp": str(offset)}
    elif source == "file":
        if start in ("initial", "earliest"):
            return {}
        if start == "timestamp":
            return {"modifiedAfter": str(offset)}
    raise ValueError(f"a {source} source cannot start at {start}")


def stream_apply(
    stream: DataFrame,
    table: KeyedTable | None,
    checkpoint: str,
    seq: Iterable[str] | str = (),
    query_id: str | None = None,
    exactly_once: bool = True,
    trigger: str = "availableNow",
    sink: str = "table",
    compact_every: int | None = None,
    compact_min_deltas: int = 8,
    vacuum_every: int | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
    **load_options,
) -> StreamingQuery:
    """Apply each micro-batch of a stream as one load: one commit whatever the number of tasks. With ``max_rows`` or ``max_bytes`` a
    larger batch becomes consecutive commits in the order of ``seq`` (:func:`parts.load_in_parts`).

    Exactly-once: the commit records the batch number under the id of the checkpoint, so a replayed batch is skipped and
    other streams into the same table are not touched by it; leftovers of a crashed run are removed first. A ``query_id`` of
    one's own belongs to the first checkpoint that uses it, another one raises. At-least-once leaves the record out. ``sink="noop"`` runs the stream and discards the rows.
    Order of changes comes from ``seq``, never from task timing. With ``merge_on_read`` every ``compact_every``-th batch
    merges the buckets that have ``compact_min_deltas`` deltas; every ``vacuum_every``-th one removes files of old versions.
    """
    if sink == "noop":
        when = {"availableNow": True} if trigger == "availableNow" else {"processingTime": trigger}
        return stream.writeStream.format("noop").option("checkpointLocation", checkpoint).trigger(**when).start()
    cleared = []

    def on_batch(batch: DataFrame, batch_id: int, stream_id: str) -> None:
        own = {"query_id": query_id or stream_id, "batch_id": batch_id, "stream_id": stream_id} if exactly_once else {}
        target = KeyedTable(batch.sparkSession, table.path)
        if not cleared:
            cleared.extend(target.abort_stale(x) for x in (query_id or stream_id, parts_id(query_id or stream_id)))
        if max_rows or max_bytes:
            load_in_parts(target, batch, seq, max_rows, max_bytes, **own, **load_options)
        else:
            target.load(batch, seq, **own, **load_options)
        upkeep(target, batch_id, compact_every, compact_min_deltas, vacuum_every)

    return start_query(stream, on_batch, checkpoint, trigger)


def upkeep(table: KeyedTable, batch_id: int, compact_every: int | None, compact_min_deltas: int, vacuum_every: int | None) -> None:
    """Merge deltas and remove old files every so many batches."""
    if compact_every and (batch_id + 1) % compact_every == 0:
        table.compact(compact_min_deltas)
    if vacuum_every and (batch_id + 1) % vacuum_every == 0:
        table.vacuum()
