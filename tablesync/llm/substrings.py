"""Substring deduplication: winnowed anchors as seeds, matches extended to windows of full length and to maximal repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import Stage, text_key

#: Words of a window; a repeat is as long at least.
WINDOW = 35
#: Words of an anchor. Of the anchors of a window the least is selected, so equal windows have equal anchors at equal places.
ANCHOR = 8
#: Words of a text that are worked on at once; neighbours overlap by a window less one word.
_BITS = 16
_CHUNK = 1 << _BITS
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Largest size of a filter that is sent to all tasks, in bits (16 MB). A full filter lets more rows pass and changes no result.
MOST_BITS = 1 << 27
KEYS = ["doc_id", "_key"]


def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for m in _MULTIPLIERS:
        one = lambda x: np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(_CHUNK, x, dtype=np.uint64))))
        out.append((one(m), one(pow(m, -1, 1 << 64))))
    return out


_POWERS = _powers()


def words(text: str | None) -> list[bytes]:
    """What space, tab and line ends separate."""
    return (text or "").encode("utf-8", "surrogatepass").split()


class Piece:
    """Hashes of up to ``_CHUNK`` words of one or more texts and the runs of windows that share an anchor.

    ``text`` numbers the text of each word; windows lie in one text. Runs are (start, count, anchor).
    """

    def __init__(self, h: np.ndarray, text: np.ndarray, window: int, anchor: int):
        n, self.window = len(h), window
        self._sums = [np.concatenate(([np.uint64(0)], np.cumsum(h * p[:n]))) for p, _ in _POWERS]
        grams = self.hashes(0, np.arange(n - anchor + 1), anchor)
        grams = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(32)
        # equal anchors of a window: the first; 48 bits decide, the place in the piece is in the others
        least = (grams & ~np.uint64(_CHUNK - 1)) | np.arange(len(grams), dtype=np.uint64)
        span, total = 1, window - anchor + 1
        while span * 2 <= total:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < total:
            least = np.minimum(least[: len(least) - (total - span)], least[total - span:])
        whole = np.flatnonzero(text[: len(least)] == text[window - 1: window - 1 + len(least)])
        at = (least[whole] & np.uint64(_CHUNK - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 0) | (np.diff(whole) != 1)))) if len(at) else whole
        self.start, self.count = whole[first], np.diff(np.append(first, len(at)))
        self.anchor = grams[at[first]].view(np.int64)

    def hashes(self, which: int, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        s = self._sums[which]
        return (s[start + length] - s[start]) * _POWERS[which][1][start]

    def both(self, start: np.ndarray, length: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self.hashes(i, start, length).view(np.int64) for i in range(2))


def _pieces(texts: list[str | None], window: int, anchor: int) -> Iterator[tuple[np.ndarray, np.ndarray, Piece]]:
    """Pieces over many texts, with the text of each word and its place there; long texts overlap by a window less one word."""
    held: list[np.ndarray] = []
    names: list[tuple[int, int]] = []
    size = 0

    def piece():
        text = np.repeat([t for t, _ in names], [len(x) for x in held])
        place = np.concatenate([np.arange(at, at + len(x)) for (_, at), x in zip(names, held)])
        return text, place, Piece(np.concatenate(held), text, window, anchor)

    for k, t in enumerate(texts):
        w = words(t)
        if len(w) < window:
            continue
        h = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype=np.uint64, count=len(w))
        for at in range(0, len(h) - window + 1, _CHUNK - window + 1):
            part = h[at:at + _CHUNK]
            if size + len(part) > _CHUNK:
                yield piece()
                held, names, size = [], [], 0
            held.append(part)
            names.append((k, at))
            size += len(part)
    if held:
        yield piece()


def _contains(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    mask, x = np.uint64(len(bits) * 8 - 1), x.view(np.uint64)
    get = lambda p: (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
    return (get(x & mask) & get((x >> np.uint64(32)) & mask)).astype(bool)


def _filter_of(values: DataFrame, column: str) -> np.ndarray:
    """Bloom filter of a column of hashes: two bits for each value. Bits are combined by aggregation; its size is bounded."""
    n = values.count()
    bits = min(MOST_BITS, 1 << max(14, (16 * n - 1).bit_length() if n else 0))
    p = values.select(F.explode(F.array(F.expr(f"{column} & {bits - 1}"), F.expr(f"shiftrightunsigned({column}, 32) & {bits - 1}"))).alias("p"))
    lines = p.groupBy(F.expr("shiftright(p, 6)").alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b"))

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(1 << 14, dtype=np.int64)
        out[part["i"].to_numpy() & ((1 << 14) - 1)] = part["b"].to_numpy()
        return pd.DataFrame({"k": [key[0]], "d": [out.tobytes()]})

    parts = lines.groupBy(F.expr("shiftright(i, 14)").alias("k")).applyInPandas(pack, "k bigint, d binary").collect()  # at most 128
    out = np.zeros(max(bits // 64, 1 << 14), dtype=np.int64)
    for r in parts:
        out[r["k"] << 14:(r["k"] + 1) << 14] = np.frombuffer(r["d"], dtype=np.int64)
    return out[:bits // 64].view(np.uint8)


class _Scan:
    """Passes over the texts; each reads whole texts and gives flat rows."""

    def __init__(self, docs: DataFrame, window: int, anchor: int):
        self.docs = docs.select("doc_id", text_key(F.col("text")).alias("_key"), "text").where("text IS NOT NULL")
        self.id_type = docs.schema["doc_id"].dataType.simpleString()
        self.window, self.anchor = window, anchor

    def anchors(self) -> DataFrame:
        window, anchor = self.window, self.anchor

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for _, _, p in _pieces(b.column(0).to_pylist(), window, anchor):
                    yield pa.record_batch({"a": p.anchor})

        return self.docs.select("text").mapInArrow(each, "a bigint")

    def places(self, known: np.ndarray, single: bool) -> DataFrame:
        """``doc_id, _key, a, h1, h2, place, start, n`` of runs, if the filter may hold their anchor; with ``single`` the windows of
        runs of which it may hold the place, a number that stands for this run in this text."""
        window, anchor = self.window, self.anchor

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, keys = b.column(0), b.column(1).to_numpy()
                for text, at, p in _pieces(b.column(2).to_pylist(), window, anchor):
                    a, start, count = p.anchor, p.start, p.count
                    if not single:
                        hit = _contains(known, a)
                        a, start, count = a[hit], start[hit], count[hit]
                    h1, h2 = p.both(start, count + (window - 1))
                    place = h1 ^ keys[text[start]] ^ (at[start] << 32)
                    if single:
                        hit = _contains(known, place)
                        a, start, count, place = (np.repeat(x[hit], count[hit]) for x in (a, start, count, place))
                        if len(start):
                            new = np.flatnonzero(np.concatenate(([True], np.diff(start) != 0)))
                            start = start + np.arange(len(start)) - np.repeat(new, np.diff(np.append(new, len(start))))
                        count = np.ones(len(start), np.int64)
                        h1, h2 = p.both(start, window)
                    yield pa.record_batch({"doc_id": ids.take(pa.array(text[start])), "_key": keys[text[start]], "a": a, "h1": h1, "h2": h2, "place": place,
                                           "start": at[start].astype(np.int32), "n": count.astype(np.int32)})

        return self.docs.mapInArrow(each, f"doc_id {self.id_type}, _key bigint, a bigint, h1 bigint, h2 bigint, place bigint, start int, n int")


def repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, _key, ranges``: runs (start, n) of window starts whose words also start elsewhere in the corpus.

    Seeds are winnowed anchors that occur more than once. A seed is extended both ways to the run of all windows that hold it;
    runs that occur more than once as a whole are repeats. Where an anchor has runs that differ, one place of each of them is
    compared window by window; the other places of a run that occurs more than once are repeats already. Equality is that of
    128-bit hashes. Groups are counted, never paired, so a passage in a third of all documents costs as many rows as it has
    places. Filters of bounded size keep other rows from being shuffled; what they let pass too much is only counted in vain.
    """
    scan, stage = _Scan(docs, window, anchor), Stage(docs.sparkSession, "substrings")
    shared = stage.write(scan.anchors().groupBy("a").agg(F.count("*").alias("c")).where("c > 1").select("a"))
    runs = stage.write(scan.places(_filter_of(shared, "a"), single=False))
    stage.drop(shared)
    kinds = stage.write(runs.groupBy("a", "h1", "h2").agg(F.count("*").alias("c"), F.min("place").alias("place")))
    mixed = kinds.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select(F.col("a").alias("_a"))
    chosen = stage.write(kinds.join(mixed, F.col("a") == F.col("_a"), "left_semi").select("place"))
    same = lambda t: t.where("c > 1").select(F.col("h1").alias("_1"), F.col("h2").alias("_2"))
    on = (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2"))
    whole = runs.join(same(kinds), on, "left_semi").select(*KEYS, "start", "n")
    single = stage.write(scan.places(_filter_of(chosen, "place"), single=True).select(*KEYS, "h1", "h2", "start", "n"))
    stage.drop(chosen)
    parts = single.join(same(single.groupBy("h1", "h2").agg(F.count("*").alias("c"))), on, "left_semi").select(*KEYS, "start", "n")
    return whole.unionAll(parts).groupBy(*KEYS).agg(F.collect_set(F.struct("start", "n")).alias("ranges"))


def _covered(ranges, n: int, window: int) -> np.ndarray:
    """Which of ``n`` words the windows cover."""
    change = np.zeros(n + 1, dtype=np.int64)
    for r in ranges:
        change[r["start"]] += 1
        change[min(n, r["start"] + r["n"] + window - 1)] -= 1
    return np.cumsum(change[:-1]) > 0


def dedup_substrings(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, _key, n_words, n_removed, spans, kept`` for each row: maximal repeats (start, end; words) and the words that stay.

    Every word of a window of ``window`` words whose sequence also starts at another place goes, all places alike. Null and empty texts
    have no words; texts of fewer words than ``window`` stay. Repeated rows are places of their own, so they remove each other.
    Kept words are joined by one space. Other columns are ignored. Texts without a repeat are not shuffled, but for the few
    that the filter lets pass.
    """
    stage = Stage(docs.sparkSession, "repeats")
    found = stage.write(repeats(docs, window, anchor).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "ranges"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, _key bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string"
    known = _filter_of(found.select(F.xxhash64("_k").alias("k")), "k")
    d = docs.select("doc_id", text_key(F.col("text")).alias("_key"), "text").withColumn("k", F.xxhash64("_key"))

    def cut(b: pa.RecordBatch, ranges: list) -> pa.RecordBatch:
        rows: list[tuple] = []
        for text, r in zip(b.column(2).to_pylist(), ranges):
            w = words(text)
            gone = _covered(r or (), len(w), window)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2).tolist()
            kept = [x for x, g in zip(w, gone.tolist()) if not g] if edges else w
            rows.append((len(w), int(gone.sum()), [{"start": s, "end": e} for s, e in edges], b" ".join(kept).decode("utf-8", "surrogatepass")))
        n, m, spans, kept = zip(*rows) if rows else ((),) * 4
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string())], names=["doc_id", "_key", "n_words", "n_removed", "spans", "kept"])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(~_contains(known, b.column(3).to_numpy())))
            yield cut(b, [None] * len(b))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_contains(known, b.column(3).to_numpy())))

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield cut(b, b.column(3).to_pylist())

    some = d.mapInArrow(maybe, f"doc_id {id_type}, _key bigint, text string, k bigint").select(*KEYS, "text")
    joined = some.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left").select(*KEYS, "text", "ranges")
    return d.mapInArrow(clean, schema).unionAll(joined.mapInArrow(repeated, schema))
