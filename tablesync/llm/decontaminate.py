"""Benchmark decontamination: windows of benchmark words as a broadcast hash set, scanned over every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import measured_bytes
from .common import MAX_BROADCAST, Stage, lower_ascii, once, repeat_rows, same, small, text_key

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words before lower-casing, each with the separators before it, and the separators after the last one.
SEPARATED_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
AFTER_LAST_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z"
WINDOW = 10
KEYS = ["doc_id", "_key"]


def words(text: Column) -> Column:
    """Runs of digits, letters and all characters beyond ASCII, A-Z lower-cased; null has none.

    Upper case is no word character of the pattern, so lower-casing comes first.
    """
    return F.regexp_extract_all(F.coalesce(lower_ascii(text), F.lit("")), F.lit(WORD), F.lit(0))


def _hash(w: Column, start: Column, length: int) -> Column:
    """Hash of ``length`` words from ``start`` (from 0). Single elements, as slices would copy the array."""
    return F.xxhash64(*[F.get(w, start + i) for i in range(length)])


def _hash_any(w: Column, start: Column, length: Column, lengths: list[int]) -> Column:
    out = F.lit(None).cast("bigint")
    for n in lengths:
        out = F.when(length == n, _hash(w, start, n)).otherwise(out)
    return out


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``hash, length, words, items``: every distinct window with the ids of its items.

    Items of fewer words are one window; items without words have none. Null ids hit but are not listed.
    """
    w = benchmark.select("item_id", once(words(F.col("text"))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))
    each = w.select("item_id", "w", F.explode(starts).alias("i")).select("item_id", F.slice("w", F.col("i") + 1, size).alias("words"))
    distinct = each.groupBy("words").agg(F.collect_set("item_id").alias("items")).withColumn("length", F.size("words"))
    return distinct.select(_hash_any(F.col("words"), F.lit(0), F.col("length"), list(range(1, size + 1))).alias("hash"), "length", "words", "items")


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``doc_id, _key, _rows, n_words, spans, items`` for every distinct (doc_id, text).

    ``spans`` are verified windows (start, end; words, from 0, end exclusive), sorted; ``items`` the sorted item ids as text.
    The windows are broadcast if they were measured below ``max_broadcast``: scan, window hashes, probe and verification are then
    one generated loop, and a document leaves it as one row and one per hit. Beyond the bound, window hashes meet in a shuffle
    join, and only documents with such a meeting are verified.
    """
    bench = benchmark_windows(benchmark, size)
    lengths = [r[0] for r in bench.select("length").distinct().orderBy("length").collect()]  # at most `size` numbers
    d = docs.select("doc_id", text_key(F.col("text")).alias("_key"), once(words(F.col("text"))).alias("_w"))
    # start -1 stands for the document itself, so that those without a hit stay
    at = d.select(*KEYS, "_w", F.explode(F.sequence(F.lit(-1), F.size("_w") - 1)).alias("start"))
    at = at.select("*", F.explode(F.array(*map(F.lit, lengths or [size]))).alias("len")).where(f"start >= 0 OR len = {(lengths or [size])[0]}")
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.size("_w"))
    probe = at.withColumn("probe", F.when(fits, _hash_any(F.col("_w"), F.col("start"), F.col("len"), lengths)))
    if measured_bytes(bench) <= max_broadcast:
        bench = F.broadcast(bench)
    else:
        light = probe.where("probe IS NOT NULL").select(*KEYS, "start", "len", "probe")
        cand = light.join(bench.select("hash").distinct(), F.col("probe") == F.col("hash"), "left_semi")
        cand = cand.groupBy(*KEYS).agg(F.collect_set(F.struct("start", "len", "probe")).alias("c")).withColumnsRenamed({k: f"c{k}" for k in KEYS})
        none = F.array(F.struct(F.lit(-1).alias("start"), F.lit(0).alias("len"), F.lit(None).cast("bigint").alias("probe")))
        both = d.join(cand, F.col("doc_id").eqNullSafe(F.col("cdoc_id")) & (F.col("_key") == F.col("c_key")), "left")
        probe = both.select(*KEYS, "_w", F.explode(F.concat(none, F.coalesce("c", F.slice(none, 1, 0)))).alias("p")).select(*KEYS, "_w", "p.*")
    equal = F.col("hash").isNotNull() & (F.slice("_w", F.greatest(F.col("start"), F.lit(0)) + 1, F.col("len")) == F.col("words"))
    found = probe.join(bench, (F.col("probe") == F.col("hash")) & (F.col("len") == F.col("length")), "left").where((F.col("start") < 0) | equal)
    span = F.when(F.col("start") >= 0, F.struct("start", (F.col("start") + F.col("len")).alias("end")))
    found = found.select(*KEYS, F.size("_w").cast("bigint").alias("n_words"), "start", "len", "items")
    return found.groupBy(*KEYS).agg(
        F.max("n_words").alias("n_words"),
        F.count_if(F.col("start") < 0).alias("_rows"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("items"))), lambda x: x.cast("string"))).alias("items"))


def covered(spans: Column) -> Column:
    """Number of words inside the sorted spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("at"))
    step = lambda a, s: F.struct(
        (a.n + F.greatest(F.lit(0), s.end - F.greatest(s.start, a.at))).cast("bigint").alias("n"), F.greatest(a.at, s.end).alias("at"))
    return F.aggregate(spans, start, step, lambda a: a.n)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Nulls and empty texts have no words and no hits. Repeated rows are returned as often as they came, with equal results;
    rows of one doc_id with different texts are judged each on its own. An empty benchmark leaves all documents clean.
    Other columns of ``docs`` are ignored.
    """
    h = hits(docs, benchmark, **options)
    out = h.select(
        "_rows", "doc_id", "n_words", covered(F.col("spans")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
    return repeat_rows(out, "_rows")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``) or without the hit words (``"spans"``).

    A removed word goes together with what stands between it and the word before. Columns and their order stay; documents
    without a hit keep their text byte for byte. Repeated rows and nulls as in :func:`contamination`.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    h = hits(docs, benchmark, **options).where(F.size("spans") > 0)
    h = h.select(F.col("doc_id").alias("__hit_id"), F.col("_key").alias("__hit_key"), F.col("spans").alias("__hit_spans"))
    h = small(Stage(docs.sparkSession, "hits").write(h))  # few documents have hits: then no text is shuffled to meet them
    on = F.col("doc_id").eqNullSafe(F.col("__hit_id")) & (text_key(F.col("text")) == F.col("__hit_key"))
    if remove == "documents":
        return docs.join(h, on, "left_anti")
    # words with their case, each with what stands before it
    pieces = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(SEPARATED_WORD), F.lit(0))
    d = docs.join(h, on, "left").select(*[f"`{c}`" for c in docs.columns], "__hit_spans", once(pieces).alias("__hit_pieces"))
    gone = F.flatten(F.transform("__hit_spans", lambda s: F.sequence(s.start, s.end - 1)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("__hit_pieces") - 1), gone), lambda i: F.get("__hit_pieces", i))
    text = F.when(F.col("__hit_spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), F.regexp_extract("text", AFTER_LAST_WORD, 0)))
    return d.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])
