"""Line deduplication: winnowed line hashes as anchors, matches extended both ways, later runs deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import Stage, once, text_key

#: Shortest repeated run of lines that is deleted; also the winnowing window, so no such run is without an anchor.
RUN = 3
#: Repeated single lines and pairs of lines go too from so many words on; with longer runs this covers every repeat of that length.
WORDS = 50
KEYS = ["doc_id", "_key"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _windows(docs: DataFrame, run: int, words: int | None) -> DataFrame:
    """``doc_id, _key, start, n, anchor, opens, seq`` for every ``n`` = ``run`` consecutive lines and fewer ones of at least ``words`` words.

    ``anchor`` is the smallest line hash of the window (ties: the last such line), ``opens`` says whether the window before has
    another anchor line, ``seq`` is a 128-bit digest of the lines themselves. Windows of fewer lines than ``run`` are their own anchors.
    """
    d = docs.where(F.col("text").isNotNull()).select("doc_id", text_key(F.col("text")).alias("_key"), once(_lines(F.col("text"))).alias("w"))
    at = d.where(F.size("w") >= run).select(*KEYS, "w", F.explode(F.sequence(F.lit(0), F.size("w") - run)).alias("start"))
    start = F.col("start")
    place = lambda i: F.struct(F.xxhash64(F.get("w", i)).alias("h"), (-i).alias("p"))
    least = lambda s: F.array_min(F.array(*[place(s + k) for k in range(run)]))
    seq = F.unhex(F.md5(F.concat_ws("\n", *[F.get("w", start + k) for k in range(run)])))
    found = at.select(*KEYS, "start", least(start).alias("a"), F.when(start > 0, least(start - 1)).alias("b"), seq.alias("seq"))
    found = found.select(*KEYS, "start", F.lit(run).alias("n"), F.col("a.h").alias("anchor"), (F.col("b").isNull() | (F.col("a.p") != F.col("b.p"))).alias("opens"), "seq")
    if words is None or run == 1:
        return found
    joined = lambda i, n: F.concat_ws("\n", F.slice("w", i + 1, n))
    wordy = lambda i, n: (i + n <= F.size("w")) & (F.length(joined(i, n)) >= 2 * words - 1) & (F.regexp_count(joined(i, n), F.lit(r"\S+")) >= words)
    sizes = F.filter(F.array(*[F.lit(n) for n in range(1, run)]), lambda n: wordy(start, n))
    few = d.select(*KEYS, "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("start")).select(*KEYS, "w", "start", F.explode(sizes).alias("n"))
    few = few.select(*KEYS, "start", "n", F.unhex(F.md5(joined(start, F.col("n")))).alias("seq"))
    return found.unionByName(few.select("*", F.xxhash64("n", "seq").alias("anchor"), F.lit(True).alias("opens")))


def repeated_windows(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """``doc_id, _key, start, n``: windows of ``run`` lines, or fewer of at least ``words`` words, whose lines also stand at an earlier place.

    Places are ordered by doc_id (nulls last), text hash and line. Anchors that occur at several places are joined with their
    positions; each such place is extended to all windows that hold it, at most ``run - 1`` lines either way, and windows that
    touch form the maximal runs. Each window is compared with the first of its kind only, so hot lines cost no pairs.
    """
    stage = Stage(docs.sparkSession, "lines")
    win = stage.write(_windows(docs, run, words))
    shared = win.where("opens").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select(F.col("anchor").alias("shared"))
    cand = stage.write(win.join(shared, F.col("anchor") == F.col("shared")).select(*KEYS, "start", "n", "seq"))
    place = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("_key").alias("k"), F.col("start").alias("s"))
    first = cand.groupBy("seq").agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1").select(F.col("seq").alias("q"), "first")
    return cand.join(first, F.col("seq") == F.col("q")).where(place > F.col("first")).select(*KEYS, "start", "n")


def _with_removed(docs: DataFrame, run: int, words: int | None) -> DataFrame:
    """``docs`` with ``__line_list`` and the numbers of the lines to delete in ``__line_gone`` (null: none)."""
    starts = repeated_windows(docs, run, words).groupBy(*KEYS).agg(F.collect_list(F.struct("start", "n")).alias("__line_starts"))
    starts = starts.select(F.col("doc_id").alias("__line_id"), F.col("_key").alias("__line_key"), "__line_starts")
    on = F.col("doc_id").eqNullSafe(F.col("__line_id")) & (text_key(F.col("text")) == F.col("__line_key"))
    gone = F.array_distinct(F.flatten(F.transform("__line_starts", lambda s: F.sequence(s.start, s.start + s.n - 1))))
    joined = docs.join(starts, on, "left").withColumn("__line_gone", gone)
    return joined.select(*[f"`{c}`" for c in docs.columns], "__line_gone", once(_lines(F.col("text"))).alias("__line_list"))


def _kept(lines: Column, gone: Column) -> Column:
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    return F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")


def dedup_lines(docs: DataFrame, run: int = RUN, words: int | None = WORDS) -> DataFrame:
    """``docs`` without later repeats of runs of at least ``run`` lines or ``words`` words; the first place of each run stays.

    Lines are what newlines separate, compared as they are; words are what white space separates. ``words=None`` leaves only
    the number of lines. Null texts have no lines and stay null, an empty text is one empty line. A text whose lines all go becomes empty, its row stays. Rows equal in doc_id and
    text are one place, so repeated rows stay alike. Columns and their order stay.
    """
    d = _with_removed(docs, run, words)
    text = F.when(F.col("__line_gone").isNull(), F.col("text")).otherwise(_kept(F.col("__line_list"), F.col("__line_gone")))
    return d.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, kept_sha256`` (of the text that stays; null counts as empty).

    By lines alone unless ``words`` is given, as the SQL of the query states it.
    """
    d = _with_removed(docs.select("doc_id", "text"), run, words)
    text = F.when(F.col("__line_gone").isNull(), F.coalesce("text", F.lit(""))).otherwise(_kept(F.col("__line_list"), F.col("__line_gone")))
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("__line_list")).cast("bigint")
    return d.select("doc_id", n.alias("n_lines"), F.coalesce(F.size("__line_gone"), F.lit(0)).cast("bigint").alias("n_removed"),
                    F.sha2(text, 256).alias("kept_sha256"))
