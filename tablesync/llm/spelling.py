"""Spelling variants: words one edit apart, found by probing generated edits in Bloom filters, confirmed by a join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import Stage, lower_ascii

LETTERS = "A-Za-zÀ-ÿ"
#: Words that a variant may consist of.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: Words of at least so many letters share the filters of one length class.
LONG = 48
#: Words of one filter, bits for each of them and bits that are set for each.
SHARD_WORDS, BITS, PROBES = 1 << 17, 16, 8
#: Filters that are broadcast together; a larger vocabulary is probed in several passes, each against other filters.
MAX_FILTERS = 64 << 20
#: Edits that a task holds at once.
EDITS = 1 << 20
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


def _at(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Hash of a letter at a place; a word's hash is the sum over its letters, so that an edit changes few terms."""
    return _mixed(place.astype(np.uint64) << np.uint64(21) | letter.astype(np.uint64))


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)


def _hash(codes: np.ndarray) -> np.ndarray:
    return _at(np.arange(codes.shape[1])[None, :], codes).sum(axis=1, dtype=np.uint64)


class Filters:
    """Blocked Bloom filters, one for each (length class, share of the hashes): all bits of a word lie in one block of 512 bits."""

    def __init__(self, shares: dict[int, int], parts: dict[tuple[int, int], bytes]):
        self.shares = shares  # length class -> number of filters
        words = [np.frombuffer(b, dtype="<u8") for b in parts.values()]
        self.bits = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        ends = np.cumsum([len(w) for w in words]) if words else []
        self.place = {k: (int(e) - len(w), len(w) // 8) for k, w, e in zip(parts, words, ends)}

    @staticmethod
    def spots(h: np.ndarray, blocks: np.ndarray | int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block of each hash, and for each of its bits the 64-bit word inside the block and the mask."""
        h = _mixed(h)
        block = ((h >> np.uint64(32)) * np.asarray(blocks, dtype=np.uint64) >> np.uint64(32)).astype(np.int64)
        g = _mixed(h + np.uint64(0x9E3779B97F4A7C15))
        bit = np.stack([(_mixed(g + np.uint64(k // 6)) >> np.uint64(9 * (k % 6))) & np.uint64(511) for k in range(PROBES)], axis=-1)
        return block, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))

    @staticmethod
    def share(h: np.ndarray, shares: int) -> np.ndarray:
        return (_mixed(h ^ _A) % np.uint64(shares)).astype(np.int64)

    @staticmethod
    def build(h: np.ndarray) -> bytes:
        blocks = max(1, -(-len(h) * BITS // 512))
        bits = np.zeros(blocks * 8, dtype=np.uint64)
        block, word, mask = Filters.spots(h, blocks)
        np.bitwise_or.at(bits, (block[:, None] * 8 + word).ravel(), mask.ravel())
        return bits.astype("<u8").tobytes()

    def holds(self, length: int, h: np.ndarray) -> np.ndarray:
        """Which hashes of words of one length may be known; filters that aren't loaded here know none."""
        c = min(length, LONG)
        out = np.zeros(len(h), dtype=bool)
        shares = self.shares.get(c, 0)
        if not shares:
            return out
        at = np.full((shares, 2), 0, dtype=np.int64)
        for s in range(shares):
            at[s] = self.place.get((c, s), (0, 0))
        mine = self.share(h, shares)
        i = np.flatnonzero(at[mine, 1] > 0)
        start, blocks = at[mine[i]].T
        block, word, mask = self.spots(h[i], blocks)
        base = start + block * 8
        for k in range(PROBES):  # most edits leave after a few bits
            ok = self.bits[base + word[:, k]] & mask[:, k] != 0
            i, base, word, mask = i[ok], base[ok], word[ok], mask[ok]
        out[i] = True
        return out


def _edits(codes: np.ndarray, letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Row numbers and edited words that the filters may know, for words of one length.

    One letter out (of equal neighbours the first), or one replaced by a later letter of the alphabet. The other direction of
    either edit is the same pair of words seen from the other side.
    """
    n, size = codes.shape
    at = _at(np.arange(size)[None, :], codes)
    whole = at.sum(axis=1, dtype=np.uint64)
    if size > 1:
        shifted = _at(np.arange(size - 1)[None, :], codes[:, 1:])  # letters that move up by one place
        before = np.cumsum(at, axis=1, dtype=np.uint64) - at
        after = np.concatenate((np.cumsum(shifted[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], np.zeros((n, 1), dtype=np.uint64)), axis=1)
        differs = np.concatenate((np.ones((n, 1), dtype=bool), codes[:, 1:] != codes[:, :-1]), axis=1)
        row, i = np.nonzero(differs)
        found = filters.holds(size - 1, before[row, i] + after[row, i])
        yield row[found], [_without(codes[r], k) for r, k in zip(row[found], i[found])]
    for i in range(size):
        rest = whole - at[:, i]
        new = _at(np.full(len(letters), i), letters)
        later = letters[None, :] > codes[:, i, None]
        row, j = np.nonzero(later)
        found = filters.holds(size, rest[row] + new[j])
        yield row[found], [_with(codes[r], i, letters[k]) for r, k in zip(row[found], j[found])]


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le")


def _without(codes: np.ndarray, i: int) -> str:
    return _text(np.delete(codes, i))


def _with(codes: np.ndarray, i: int, letter: int) -> str:
    out = codes.copy()
    out[i] = letter
    return _text(out)


def noisy_words(docs: DataFrame, every: int = 97) -> DataFrame:
    """``word, n``: lower-cased (A-Z) runs of letters of all texts with their counts, some with a letter left out.

    Where ``every`` divides the CRC-32 of ``<doc_id>:<word>``, the letter at that number modulo the length is deleted (nothing is left of words
    of one letter). The deletion is planted noise that makes the task's answer known; a null id counts as an empty one.
    """
    runs = F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"([{LETTERS}]+)"), F.lit(1)))
    # a document's repeats of a word fare alike, so they are counted before anything else happens to them
    w = docs.select("doc_id", runs.alias("w"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("w")).cast("binary"))
    w = w.select("w", h.alias("h"))
    k = (F.col("h") % F.length("w")).cast("int")
    cut = F.concat(F.substring("w", 1, k), F.expr("substring(w, cast(h % length(w) as int) + 2)"))
    return w.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("w")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _hashed(words: DataFrame) -> DataFrame:
    """``size, h`` of each word."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_size: dict[int, list[str]] = {}
            for w in b.column(0).to_pylist():
                by_size.setdefault(len(w), []).append(w)
            for size, some in by_size.items():
                step = max(1, EDITS // size)
                for at in range(0, len(some), step):
                    h = _hash(_codes(some[at:at + step]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), min(size, LONG), np.int32)), pa.array(h.view(np.int64))], names=["class", "h"])

    return words.select("word").mapInArrow(each, "class int, h bigint")


def near_pairs(words: DataFrame, stage: Stage, max_filters: int = MAX_FILTERS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n, near, n_near_word``: all pairs of words that differ by one inserted, deleted or replaced letter, in both directions.

    ``words`` (``word, n``) are distinct and written. Their hashes are dealt to blocked Bloom filters by length class and hash, each filter built
    by one task from at most about ``shard_words`` hashes. The filters are broadcast ``max_filters`` bytes at a time: a vocabulary beyond that is
    probed in several passes over other filters. Each word generates its edits as hashes; only those that a filter knows
    become words again and are shuffled to the join with the vocabulary, which removes the filters' errors.
    """
    spark = words.sparkSession
    hashed = stage.write(_hashed(words))
    shares = {r["class"]: -(-r["c"] // shard_words) for r in hashed.groupBy("class").agg(F.count("*").alias("c")).collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().where("c != ''")
    letters = np.array(sorted(ord(r.c) for r in letters.collect()), dtype=np.uint32)  # bounded by the alphabet

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, h = b.column(0).to_numpy(), b.column(1).to_numpy()
            n = np.array([shares[x] for x in c.tolist()], dtype=np.uint64)
            s = (_mixed(h.view(np.uint64) ^ _A) % n).astype(np.int32) if len(h) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), b.column(1)], names=["class", "share", "h"])

    def build(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"class": p["class"][:1], "share": p["share"][:1], "bits": [Filters.build(p["h"].to_numpy(np.int64).view(np.uint64))]})

    built = hashed.mapInArrow(deal, "class int, share int, h bigint").groupBy("class", "share").applyInPandas(build, "class int, share int, bits binary")
    built = stage.write(built)
    sizes = built.select("class", "share", F.octet_length("bits").alias("b")).orderBy("class", "share").collect()  # a row for 131,072 words
    passes: list[list] = []
    for r in sizes:
        if not passes or sum(x["b"] for x in passes[-1]) + r["b"] > max_filters:
            passes.append([])
        passes[-1].append(r)
    found = None
    for some in passes:
        keys = spark.createDataFrame([(r["class"], r["share"]) for r in some], "class int, share int")
        parts = {(r["class"], r["share"]): bytes(r["bits"]) for r in built.join(F.broadcast(keys), ["class", "share"]).collect()}
        known = spark.sparkContext.broadcast((shares, parts))
        met = {c for c, _ in parts}

        def probe(batches: Iterator[pa.RecordBatch], known=known, met=met) -> Iterator[pa.RecordBatch]:
            filters = Filters(*known.value)
            for b in batches:
                by_size: dict[int, tuple[list, list]] = {}
                for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if met & {min(len(w), LONG), min(len(w) - 1, LONG)}:
                        some = by_size.setdefault(len(w), ([], []))
                        some[0].append(w)
                        some[1].append(n)
                for size, (some, counts) in by_size.items():
                    step = max(1, EDITS // max(size, len(letters)))
                    for at in range(0, len(some), step):
                        codes = _codes(some[at:at + step])
                        for rows, edited in _edits(codes, letters, filters):
                            if len(rows):
                                pick = (rows + at).tolist()
                                yield pa.RecordBatch.from_arrays([pa.array([some[i] for i in pick]), pa.array([counts[i] for i in pick], pa.int64()), pa.array(edited)], names=["word", "n", "near"])

        # few rows of much work: spread by the number of words, not by bytes
        spread = words.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        hits = stage.write(spread.select("word", "n").mapInArrow(probe, "word string, n bigint, near string"))
        known.unpersist()
        found = hits if found is None else found.unionAll(hits)
    if found is None:
        found = words.select("word", "n", F.col("word").alias("near")).limit(0)
    known_words = words.select(F.col("word").alias("near"), F.col("n").alias("m"))
    pairs = stage.write(found.join(known_words, "near"))
    return pairs.select("word", "n", "near", "m").unionAll(pairs.select(F.col("near").alias("word"), F.col("m").alias("n"), F.col("word").alias("near"), F.col("n").alias("m")))


def _roots(forms: DataFrame, stage: Stage) -> DataFrame:
    """``word, root``: the last word on the way from form to form, found by doubling the steps in each round.

    Counts at least double from a word to its form, so a way has no circle and at most as many steps as the largest count has bits.
    """
    now = stage.write(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("on"))
        new = now.join(onward, "root", "left").select("word", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved"))
        new = stage.write(new)
        done = new.where("moved").isEmpty()
        stage.drop(now)
        now = new.select("word", "root")
        now._stage_path = new._stage_path
        if done:
            return now


def _small_order(word: Column) -> Column:
    """Binary order of UTF-8, which is the order of code points."""
    return F.encode(word, "UTF-8")


def group_variants(words: DataFrame, letters: int = LEAST_LETTERS, count: int = LEAST_COUNT, factor: int = 2, **options) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``words`` (``word, n``) that are long and frequent enough.

    Near words differ by one inserted, deleted or replaced letter. ``form`` is the near word of the largest count (ties: the smallest), if that
    is at least ``factor`` times the word's own, else null; ``root`` follows forms to the last one and is the word itself without a form.
    Rows of equal words count together; null words are ignored; other columns are ignored. No rows give no rows.
    """
    stage = Stage(words.sparkSession, "spelling")
    known = words.where(F.length("word") >= letters).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)
    known = stage.write(known)
    pairs = near_pairs(known, stage, **options)
    best = F.min(F.struct((-F.col("m")).alias("m"), _small_order(F.col("near")).alias("b"))).alias("best")
    near = pairs.groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.m") >= factor * F.col("n")
    near = stage.write(near.select("word", "n_near", F.when(fits, F.decode("best.b", "UTF-8")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")))
    roots = _roots(near.where("form IS NOT NULL"), stage)
    out = known.join(near, "word", "left").join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def spelling_variants(docs: DataFrame, every: int = 97, **options) -> DataFrame:
    """:func:`group_variants` of the words of :func:`noisy_words`. Null and empty texts have no words, repeated rows count again."""
    return group_variants(noisy_words(docs, every), **options)
