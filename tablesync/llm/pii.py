"""Personal data: patterns for identifiers, and terms that reveal them by corpus co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import Stage, once, small, text_key

KINDS = ("email", "ip", "card", "phone")
#: Leftmost matches as the plain patterns have them, written without backtracking so that long texts cost linear time. A local part
#: begins where its run of characters begins or the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without a match of this has none of the kind; cheaper than the pattern.
HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
OCTETS = r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(?:\.|\z)){4}\z"
#: Terms beside an entity: so many words on either side, within so many characters.
NEAR_WORDS, NEAR_CHARS, TERM_LETTERS = 3, 64, 3
#: Weight, in documents, of an entity's share of the corpus in the estimate of its share among the documents of a term.
PRIOR = 1.0
#: Share of an entity's information that a term gives away: from here it is generalised, from there removed.
GENERALISE, REMOVE = 0.8, 0.95
_CHUNK = 256
KEYS = ["doc_id", "_key"]


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return total + F.when(twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    n = F.length(_digits(v))
    if kind == "ip":
        return v.rlike(OCTETS)
    if kind == "card":
        return n.between(14, 19) & F.when(n.between(14, 19), _luhn(_digits(v))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _located(kind: str, found: Column, gaps: Column) -> Column:
    """Matches with their places: lengths of what lies between and of the matches are added up, in chunks so that arrays stay short."""
    k = KINDS.index(kind)
    match = lambda at, i: F.struct(
        (at + F.length(F.get(gaps, i))).alias("start"), F.lit(k).alias("k"), (at + F.length(F.get(gaps, i)) + F.length(F.get(found, i))).alias("end"),
        F.get(found, i).alias("value"),
        F.when(F.length(F.get(gaps, i)) > NEAR_CHARS, F.right(F.get(gaps, i), F.lit(NEAR_CHARS))).otherwise(F.concat(F.lit(" "), F.get(gaps, i))).alias("before"),
        F.when(F.length(F.get(gaps, i + 1)) > NEAR_CHARS, F.left(F.get(gaps, i + 1), F.lit(NEAR_CHARS))).otherwise(F.concat(F.get(gaps, i + 1), F.lit(" "))).alias("after"))
    kind_of = "array<struct<start:int,k:int,end:int,value:string,before:string,after:string>>"
    none, n = F.array().cast(kind_of), F.size(found)

    def chunk(acc: Column, c: Column) -> Column:
        inner = F.aggregate(
            F.sequence(c, F.least(c + (_CHUNK - 1), n - 1)), F.struct(acc.at.alias("at"), none.alias("out")),
            lambda x, i: F.struct((x.at + F.length(F.get(gaps, i)) + F.length(F.get(found, i))).alias("at"), F.array_append(x.out, match(x.at, i)).alias("out")))
        return F.get(F.transform(F.array(inner), lambda z: F.struct(z.at.alias("at"), F.array_append(acc.parts, z.out).alias("parts"))), F.lit(0))

    all_of = F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(_CHUNK)), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind_of}>").alias("parts")), chunk, lambda a: F.flatten(a.parts))
    return F.when(n > 0, F.filter(all_of, lambda m: _valid(kind, m.value))).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, _key, spans``: for each row the valid matches (start, k, end, value, before, after), by start, then kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hit = {k: F.when(text.contains(HINTS[k]), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(F.array().cast("array<string>")) for k in KINDS}
    d = docs.select("doc_id", text_key(F.col("text")).alias("_key"), text.alias("text"), once(F.struct(*[c.alias(k) for k, c in hit.items()])).alias("m"))
    gaps = {k: F.when(F.size(f"m.{k}") > 0, F.split("text", PATTERNS[k], -1)) for k in KINDS}
    d = d.select(*KEYS, "m", once(F.struct(*[c.alias(k) for k, c in gaps.items()])).alias("g"))
    return d.select(*KEYS, F.array_sort(F.concat(*[_located(k, F.col(f"m.{k}"), F.col(f"g.{k}")) for k in KINDS])).alias("spans"))


def _neighbours(spans: DataFrame) -> DataFrame:
    """``value, term``: the words beside each span, lower-cased."""
    s = spans.select(F.explode("spans").alias("s"))
    parts = []
    for j in range(NEAR_WORDS):
        left = r"(?<=\P{L})(\p{L}++)((?:\P{L}++\p{L}++){%d}\P{L}*+)\z" % j
        right = r"\A(\P{L}*+(?:\p{L}++\P{L}++){%d})(\p{L}++)(?=\P{L})" % j
        parts += [F.regexp_extract("s.before", left, 1), F.regexp_extract("s.after", right, 2)]
    t = s.select(F.col("s.value").alias("value"), F.explode(F.array(*parts)).alias("t")).where(F.length("t") >= TERM_LETTERS)
    return t.select("value", F.lower("t").alias("term"))


def _outside(terms: DataFrame, spans: DataFrame) -> DataFrame:
    """Terms that lie in no span, not even in part. Letters hold no whole span, so their ends decide; both sides meet by stretches of text."""
    stretch = lambda c: F.floor(F.col(c) / NEAR_CHARS)
    s = spans.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), F.explode("spans").alias("s")).select("_id", "_k", "s.start", "s.end")
    s = s.select("*", F.explode(F.sequence(stretch("start"), F.floor((F.col("end") - 1) / NEAR_CHARS))).alias("_b"))
    for at in (F.col("t_start"), F.col("t_end") - 1):
        on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.floor(at / NEAR_CHARS) == F.col("_b"))
        terms = terms.join(s, on & (at >= F.col("start")) & (at < F.col("end")), "left_anti")
    return terms


def _starts(found: Column, gaps: Column) -> Column:
    """Where each match starts: lengths of what lies between and of the matches added up, in chunks as in :func:`_located`."""
    none, n = F.array().cast("array<int>"), F.size(found)
    until = lambda at, i: at + F.length(F.get(gaps, i))

    def chunk(acc: Column, c: Column) -> Column:
        inner = F.aggregate(
            F.sequence(c, F.least(c + (_CHUNK - 1), n - 1)), F.struct(acc.at.alias("at"), none.alias("out")),
            lambda x, i: F.struct((until(x.at, i) + F.length(F.get(found, i))).alias("at"), F.array_append(x.out, until(x.at, i)).alias("out")))
        return F.get(F.transform(F.array(inner), lambda z: F.struct(z.at.alias("at"), F.array_append(acc.parts, z.out).alias("parts"))), F.lit(0))

    all_of = F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(_CHUNK)), F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("parts")), chunk, lambda a: F.flatten(a.parts))
    return F.when(n > 0, all_of).otherwise(none)


def _occurrences(docs: DataFrame, held: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc_id, _key, term, t_start, t_end``: every place of a word of ``terms`` in the documents of ``held``."""
    h = held.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"))
    d = docs.select("doc_id", text_key(F.col("text")).alias("_key"), "text").join(h, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left_semi")
    word = F.lit(r"\p{L}+")
    d = d.dropDuplicates(KEYS).select(*KEYS, once(F.struct(F.regexp_extract_all("text", word, F.lit(0)).alias("found"), F.split("text", r"\p{L}+", -1).alias("gaps"))).alias("w"))
    d = d.select(*KEYS, F.explode(F.arrays_zip(F.col("w.found").alias("word"), _starts(F.col("w.found"), F.col("w.gaps")).alias("at"))).alias("o"))
    o = d.where(F.length("o.word") >= TERM_LETTERS).select(*KEYS, F.lower("o.word").alias("term"), F.col("o.at").alias("t_start"), (F.col("o.at") + F.length("o.word")).alias("t_end"))
    return o.join(small(terms), "term", "left_semi").select(*KEYS, "term", "t_start", "t_end")


def _disclosure(total: int, n_te: Column, n_t: Column, n_e: Column) -> Column:
    """Share of an entity's information that a term gives away.

    Entity e in n(e) of N documents has information -log2 p(e), p(e) = n(e)/N. Among the n(t) documents of a term its share is estimated as
    p(e|t) = (n(t,e) + PRIOR p(e)) / (n(t) + PRIOR), so few documents weigh less than many; the pointwise mutual information is log2 p(e|t)/p(e).
    """
    p_e = n_e / F.lit(float(total))
    return F.log2((n_te + PRIOR * p_e) / (n_t + PRIOR) / p_e) / -F.log2(p_e)


def _documents_of_words(docs: DataFrame) -> DataFrame:
    """``word, n_t``: in how many documents each word stands."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n_t"))


def document_terms(docs: DataFrame, total: int, held: DataFrame, entities: DataFrame, least: float = GENERALISE) -> DataFrame:
    """``value, term, n_e, n_t`` as :func:`possible_terms`, with every word of an entity's documents as a term, near or not.

    Entities of the same documents (equal numbers and sums of two hashes of them) give away the same; one stands for them, so a
    document of many entities of its own doesn't pair all of them with all of its words.
    """
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), *KEYS).cast("decimal(20,0)"))
    n_e = entities.groupBy("value").agg(F.count("*").alias("n_e"), mark(1).alias("x"), mark(2).alias("y"))
    first = n_e.where(F.col("n_e") < total).groupBy("n_e", "x", "y").agg(F.min("value").alias("_v")).select("_v", "n_e")
    e = entities.join(first, F.col("value") == F.col("_v")).select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "value", "n_e")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k"))
    h = held.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"))
    d = docs.select("doc_id", text_key(F.col("text")).alias("_key"), "text").join(h, same, "left_semi")
    t = d.select(*KEYS, F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("term"))
    t = t.where(F.length("term") >= TERM_LETTERS).join(_documents_of_words(docs), F.col("term") == F.col("word"))
    can = _disclosure(total, F.least("n_t", "n_e"), F.col("n_t"), F.col("n_e")) >= least
    return t.join(e, same & can).select("value", "term", "n_e", "n_t").distinct()


def possible_terms(docs: DataFrame, total: int, near: DataFrame, entities: DataFrame, least: float = GENERALISE) -> DataFrame:
    """``value, term, n_e, n_t``: terms beside an entity that could reach ``least`` if all their documents that can hold it do."""
    n_e = entities.groupBy("value").agg(F.count("*").alias("n_e")).withColumnRenamed("value", "_v")
    terms = near.select("term").distinct()
    n_t = _documents_of_words(docs).join(terms.withColumnRenamed("term", "_t"), F.col("word") == F.col("_t"))
    p = near.join(n_e, F.col("value") == F.col("_v")).join(n_t, F.col("term") == F.col("word")).where(F.col("n_e") < total)
    p = p.where(_disclosure(total, F.least("n_t", "n_e"), F.col("n_t"), F.col("n_e")) >= least)
    return p.select("value", "term", "n_e", "n_t")


def personal_spans(docs: DataFrame, generalise: float = GENERALISE, near: bool = True) -> DataFrame:
    """``doc_id, _key, base, terms`` for each row: pattern spans and revealing terms (start, end, disclosure).

    Only documents that hold an entity get terms, so documents without personal data have no spans. A term is judged if it stands
    beside the entity in any document; then its documents are counted by their whole texts, however few, and each of its places
    in documents that hold the entity is marked. Without ``near`` every word of a document is judged with every entity of it. Null texts are empty. Repeated rows have equal spans.
    """
    stage = Stage(docs.sparkSession, "pii")
    total = docs.count()
    base = stage.write(base_spans(docs))
    held = base.where(F.size("spans") > 0)
    entities = stage.write(held.select(*KEYS, F.explode("spans.value").alias("value")).distinct())
    if near:
        maybe = stage.write(possible_terms(docs, total, stage.write(_neighbours(held).distinct()), entities, generalise))
    else:
        maybe = stage.write(document_terms(docs, total, held, entities, generalise))
    places = stage.write(_occurrences(docs, held, maybe.select("term").distinct()))
    both = places.select(*KEYS, "term").distinct().join(maybe.withColumnRenamed("term", "_t"), F.col("term") == F.col("_t")).drop("_t")
    e = entities.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), F.col("value").alias("_v"))
    both = stage.write(both.join(e, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.col("value") == F.col("_v")), "left_semi"))
    reveal = both.groupBy("value", "term").agg(F.count("*").alias("n_te"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
    reveal = reveal.select(F.col("value").alias("_v"), F.col("term").alias("_t"), _disclosure(total, F.col("n_te"), F.col("n_t"), F.col("n_e")).alias("disclosure")).where(F.col("disclosure") >= generalise)
    told = both.join(reveal, (F.col("value") == F.col("_v")) & (F.col("term") == F.col("_t"))).groupBy(*KEYS, "term").agg(F.max("disclosure").alias("disclosure"))
    told = told.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), F.col("term").alias("_t"), "disclosure")
    hit = places.join(told, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")) & (F.col("term") == F.col("_t"))).select(*KEYS, "t_start", "t_end", "disclosure")
    hit = _outside(hit, held)
    hit = hit.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(F.col("t_start").alias("start"), F.col("t_end").alias("end"), "disclosure"))).alias("_terms"))
    hit = hit.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "_terms")
    none = F.array().cast("array<struct<start:int,end:int,disclosure:double>>")
    joined = base.join(hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left")
    return joined.select(*KEYS, F.col("spans").alias("base"), F.coalesce("_terms", none).alias("terms"))


def _name(k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, [*KINDS, "term"])), k + 1)


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id``, counts of the kinds, ``base_sha256`` of the pattern spans, ``spans`` with the terms."""
    p = personal_spans(docs.select("doc_id", "text"), **options)
    line = lambda m: F.concat_ws(":", _name(m.k), m.start, m.end)
    short = F.transform("base", lambda m: F.struct(m.start.alias("start"), m.k.alias("k"), m.end.alias("end")))
    more = F.transform("terms", lambda m: F.struct(m.start.alias("start"), F.lit(len(KINDS)).alias("k"), m.end.alias("end")))
    count = lambda i: F.size(F.filter("base", lambda m: m.k == i)).cast("bigint")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return p.select("doc_id", *counts, F.sha2(F.array_join(F.transform("base", line), ","), 256).alias("base_sha256"),
                    F.array_join(F.transform(F.array_sort(F.concat(short, more)), line), ",").alias("spans"))


def sanitise(docs: DataFrame, remove: float = REMOVE, **options) -> DataFrame:
    """``docs`` with pattern spans as ``[EMAIL]`` and the like, terms generalised to ``[TERM]`` or, from ``remove`` on, taken out.

    Overlapping spans become one, named after the first. Columns and their order, null texts and texts without spans stay.
    """
    p = personal_spans(docs.select("doc_id", "text"), **options).where(F.size("base") > 0).dropDuplicates(KEYS)
    spans = F.array_sort(F.concat(
        F.transform("base", lambda m: F.struct(m.start.alias("start"), m.end.alias("end"), F.concat(F.lit("["), F.upper(_name(m.k)), F.lit("]")).alias("put"))),
        F.transform("terms", lambda m: F.struct(m.start.alias("start"), m.end.alias("end"), F.when(m.disclosure >= remove, F.lit("")).otherwise(F.lit("[TERM]")).alias("put")))))
    p = p.select(F.col("doc_id").alias("__pii_id"), F.col("_key").alias("__pii_key"), spans.alias("__pii_spans"))
    on = F.col("doc_id").eqNullSafe(F.col("__pii_id")) & (text_key(F.col("text")) == F.col("__pii_key"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    step = lambda a, s: F.when(s.start < a.at, F.struct(F.greatest(a.at, s.end).alias("at"), a.out.alias("out"))).otherwise(F.struct(
        s.end.alias("at"), F.concat(a.out, F.array(F.substr(F.col("text"), a.at + 1, s.start - a.at), s.put)).alias("out")))
    whole = F.aggregate("__pii_spans", start, step, lambda a: F.concat(F.array_join(a.out, ""), F.substr(F.col("text"), a.at + 1, F.length("text"))))
    text = F.when(F.col("__pii_spans").isNull(), F.col("text")).otherwise(whole)
    d = docs.join(p, on, "left")
    return d.select(*[(text if c == "text" else F.col(f"`{c}`")).alias(c) for c in docs.columns])
