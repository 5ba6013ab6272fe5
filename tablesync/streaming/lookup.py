"""Processing-time lookup join of a stream."""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.lookup import BROADCAST_BYTES, CachedDimension, lookup_join
from .apply import start_query
from .cache import KeyCache


def stream_lookup_join(
    stream: DataFrame,
    dim_reader: Callable[[], DataFrame],
    on: Iterable[str],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    how: str = "inner",
    ttl_ms: int = 5000,
    trigger: str = "availableNow",
    max_broadcast_bytes: int = BROADCAST_BYTES,
    keys: KeyCache | None = None,
) -> StreamingQuery:
    """Join each micro-batch with the dimension table as of now, refreshed once it is older than ``ttl_ms``.

    A static side of a stream is listed once and never sees later files, so the dimension is read inside the batch.
    With ``keys`` rows are kept by key instead: only keys that no live part of the cache holds are read (:class:`cache.KeyCache`, whose TTL
    counts then). ``write(joined, batch_id)`` runs again when a batch is replayed: it should replace what it wrote for that number.
    """
    cache = CachedDimension(dim_reader, ttl_ms, max_bytes=max_broadcast_bytes)

    def on_batch(batch: DataFrame, batch_id: int, _: str) -> None:
        batch.persist()  # the join looks at its keys before it joins
        try:
            dim = keys.rows(batch, dim_reader, on, max_broadcast_bytes) if keys else cache.get()
            write(lookup_join(batch, dim, on, how, max_broadcast_bytes), batch_id)
        finally:
            batch.unpersist()

    return start_query(stream, on_batch, checkpoint, trigger)
