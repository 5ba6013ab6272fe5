"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..session import measured_bytes
from .common import MAX_BROADCAST, Stage, text_key

THRESHOLD = 0.7
#: Public insults of four languages; the first lexicon voter. Further lexicons are induced from labelled rows.
INSULTS = (
    "clown", "crétin", "dumm", "débile", "disgusting", "dummkopf", "estúpido", "garbage", "idiot", "idiota", "idiote", "imbécil",
    "imbécile", "loser", "moron", "pathetic", "pendejo", "pute", "salaud", "scum", "stupid", "trash", "trottel", "vermin", "worthless",
)
#: Induced lexicons: at most so many words or word beginnings, each in so many labelled toxic words, so many times as often as elsewhere.
LEXICON_SIZE, LEXICON_COUNT, LEXICON_RATIO = 1000, 8, 20.0
PREFIXES = (4, 5, 6)
#: Labelled rows on which the classifier is fitted, at most.
SAMPLE = 20_000
#: Share of given labels that are taken to be right.
LABEL_TRUST = 0.98
VOTERS = ("insult", "word", "beginning", "several", "dense", "shout", "address", "short")
FEATURES = ("n_words", "insult", "word", "beginning", "distinct", "shout", "address")
_WORD = re.compile(r"[^\W\d_]+")
_ADDRESS = re.compile(r"\b(?:you|tu|vous|du|ihr|usted)\W+(?:are|es|êtes|bist|seid|eres)\b", re.IGNORECASE)


def held_out(doc_id: Column) -> Column:
    """A third of the rows, by crc32 of the id as text; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, _key, text, toxic`` of the rows to learn from: one label per id (the most frequent, ties: 1), ids held out left away."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")).withColumnRenamed("doc_id", "_id")
    known = F.broadcast(known) if measured_bytes(known) <= MAX_BROADCAST else known
    return docs.join(known, F.col("doc_id") == F.col("_id")).select("doc_id", text_key(F.col("text")).alias("_key"), "text", "toxic")


def induce_lexicon(learn: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Words and word beginnings that stand out in the toxic rows; copies of a text count once. Two bounded sets."""
    one = learn.where("text != ''").groupBy("_key").agg(F.min("doc_id").alias("_first")).withColumnRenamed("_key", "_k")
    rows = learn.join(one, (F.col("doc_id") == F.col("_first")) & (F.col("_key") == F.col("_k")))
    w = rows.select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))).alias("w"))
    kinds = F.array(F.struct(F.lit(0).alias("n"), F.col("w").alias("t")), *[F.struct(F.lit(n).alias("n"), F.when(F.length("w") > n, F.left("w", F.lit(n))).alias("t")) for n in PREFIXES])
    terms = w.select("toxic", F.explode(kinds).alias("k")).where("k.t IS NOT NULL").groupBy("k.n", "k.t").agg(F.sum("toxic").alias("a"), F.count("*").alias("c"))
    size = w.groupBy("toxic").count().collect()
    all_of = {r["toxic"]: r["count"] for r in size}
    share = (all_of.get(0, 0) + 1) / (all_of.get(1, 0) + 1)
    ratio = (F.col("a") + 0.5) / (F.col("c") - F.col("a") + 0.5) * share
    best = terms.where((F.col("a") >= LEXICON_COUNT) & (ratio >= LEXICON_RATIO)).orderBy((F.col("a") * F.log(ratio)).desc(), "n", "t").limit(LEXICON_SIZE).collect()
    return frozenset(r["t"] for r in best if r["n"] == 0), frozenset(r["t"] for r in best if r["n"])


def features(docs: DataFrame, words: frozenset[str], beginnings: frozenset[str]) -> DataFrame:
    """``doc_id`` (as text), ``_key`` and FEATURES for each row: word counts by lexicon, distinct hits, words in capitals, addresses."""
    insults, sizes = frozenset(INSULTS), sorted({len(p) for p in beginnings})
    heads = frozenset(t[:4] for t in (*insults, *words, *beginnings))

    def count(text: str | None) -> tuple:
        found = _WORD.findall(text or "")
        a = b = c = 0
        seen = set()
        for w in found:
            w = w.lower()
            if w[:4] not in heads:
                continue
            if w in insults:
                a += 1
            elif w in words:
                b += 1
            elif any(w[:n] in beginnings for n in sizes):
                c += 1
            else:
                continue
            seen.add(w)
        shout = sum(1 for w in found if len(w) > 3 and w.isupper())
        return len(found), a, b, c, len(seen), shout, sum(1 for _ in _ADDRESS.finditer(text or ""))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            yield pd.concat([p[["doc_id", "_key"]], pd.DataFrame([count(t) for t in p["text"]], columns=list(FEATURES), index=p.index)], axis=1)

    d = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_key(F.col("text")).alias("_key"), "text")
    return d.mapInPandas(each, "doc_id string, _key bigint, " + ", ".join(f"{f} bigint" for f in FEATURES))


def votes() -> dict[str, Column]:
    """What each voter says of a row of features: 1 toxic, -1 not toxic, 0 nothing."""
    hits = F.col("insult") + F.col("word") + F.col("beginning")
    lexicon = lambda c: F.when(F.col(c) > 0, 1).otherwise(-1)
    return {
        "insult": F.when(F.col("insult") > 0, 1).otherwise(0),
        "word": lexicon("word"),
        "beginning": lexicon("beginning"),
        "several": F.when(F.col("distinct") >= 3, 1).when(F.col("distinct") == 0, -1).otherwise(0),
        "dense": F.when(hits * 200 >= F.greatest("n_words", F.lit(1)), 1).when(hits == 0, -1).otherwise(0),
        "shout": F.when(F.col("shout") * 5 > F.greatest("n_words", F.lit(1)), 1).otherwise(0),
        "address": F.when((F.col("address") > 0) & (hits > 0), 1).otherwise(0),
        "short": F.when((F.col("n_words") < 5) & (hits == 0), -1).otherwise(0),
    }


class LabelModel:
    """Votes as a mixture of two classes, fitted by EM over vote patterns and their numbers.

    Every voter has its own probabilities per class (its accuracy). Correlations of voters within a class are estimated from the
    same posteriors; a voter's evidence is divided by the size of the group that it moves with, so voters that say the same
    thing count about once. Rows with a given label hold the classes in place.
    """

    def __init__(self, patterns: np.ndarray, gold: np.ndarray, counts: np.ndarray, rounds: int = 30):
        m = patterns.shape[1]
        one_hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
        told = np.where(gold == 1, LABEL_TRUST, 1 - LABEL_TRUST)
        post = np.where(gold >= 0, told, np.where((patterns == 1).any(axis=1), 0.6, 0.1))
        self.weights = np.ones(m)
        for _ in range(rounds):
            w = np.stack([(1 - post) * counts, post * counts])
            self.prior = (w.sum(axis=1) + 1) / (w.sum() + 2)
            self.table = (np.einsum("cp,pjv->cjv", w, one_hot) + 0.5) / (w.sum(axis=1)[:, None, None] + 1.5)
            shared = np.zeros((m, m))
            for c in range(2):
                mean = (w[c] @ patterns) / max(w[c].sum(), 1e-9)
                dev = patterns - mean
                cov = (dev * w[c][:, None]).T @ dev / max(w[c].sum(), 1e-9)
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                shared += self.prior[c] * np.clip(cov / sd[:, None] / sd[None, :], 0, 1)
            np.fill_diagonal(shared, 0)
            self.correlations, self.weights = shared, 1 / (1 + shared.sum(axis=1))
            post = self.posterior(patterns)
            post = np.where(gold >= 0, post * told / (post * told + (1 - post) * (1 - told)), post)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        at = np.arange(patterns.shape[1])[None, :]
        log = np.log(self.table[1][at, patterns + 1]) - np.log(self.table[0][at, patterns + 1])
        return 1 / (1 + np.exp(-np.clip(np.log(self.prior[1] / self.prior[0]) + log @ self.weights, -30, 30)))


def _inputs(c) -> list:
    """Inputs of the linear classifier, of numpy arrays or columns alike: the log counts, whether any, and hits per root of words."""
    log = np.log1p if isinstance(c["n_words"], np.ndarray) else F.log1p
    root = np.sqrt if isinstance(c["n_words"], np.ndarray) else F.sqrt
    hits = c["insult"] + c["word"] + c["beginning"]
    return [log(c["insult"]), log(c["word"]), log(c["beginning"]), log(c["distinct"]), hits / (hits + 1.0), hits / root(c["n_words"] + 1.0), log(c["shout"]), log(c["address"])]


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Logistic regression on posterior labels by Newton steps; the last weight is the constant."""
    x, b = np.column_stack([x, np.ones(len(x))]), np.zeros(x.shape[1] + 1)
    penalty = np.diag([ridge] * (len(b) - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return b


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted`` and ``_key``, the hash of the text.

    Labels are read only of ids that are not held out; score inputs are counts over the whole text and nothing else. Lexicons come
    from all those rows, vote patterns from all rows not held out, the classifier from at most ``sample`` labelled rows (smallest
    hashes of the id). Null and empty texts have no words and a score like any text without hits. Labels other than 0 and 1 are none; of
    several labels of an id the mean decides. Repeated rows score alike. Without labels of both classes the insults alone vote.
    """
    stage = Stage(docs.sparkSession, "toxicity")
    id_type = docs.schema["doc_id"].dataType
    learn = _labelled(docs.select("doc_id", "text"), labels)
    words, beginnings = induce_lexicon(learn)
    f = stage.write(features(docs, words, beginnings).withColumn("held_out", held_out(F.col("doc_id"))))
    gold = learn.select(F.col("doc_id").cast("string").alias("_id"), F.col("_key").alias("_k"), "toxic").distinct()
    marked = f.where(~F.col("held_out")).join(gold, (F.col("doc_id") == F.col("_id")) & (F.col("_key") == F.col("_k")), "left")
    marked = marked.select("doc_id", *FEATURES, *[v.alias(f"v_{k}") for k, v in votes().items()], F.coalesce("toxic", F.lit(-1)).alias("gold"))
    marked = stage.write(marked)
    at = [f"v_{k}" for k in VOTERS]
    seen = marked.groupBy(*at, "gold").count().collect()  # at most 3^8 patterns, three kinds of rows
    table = np.array([[*(r[c] for c in at), r["gold"], r["count"]] for r in seen], dtype=np.int64).reshape(-1, len(at) + 2)
    patterns, given, counts = table[:, :-2], table[:, -2], table[:, -1].astype(float)
    model = LabelModel(patterns, given, counts)
    rows = marked.where("gold >= 0").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    if not rows.empty and rows["gold"].nunique() > 1:
        post = model.posterior(rows[at].to_numpy(np.int64))
        told = np.where(rows["gold"] == 1, LABEL_TRUST, 1 - LABEL_TRUST)
        y = post * told / (post * told + (1 - post) * (1 - told))
        weights = fit_linear(np.column_stack(_inputs({c: rows[c].to_numpy(float) for c in FEATURES})), y)
    else:
        weights = np.array([2.0] * 4 + [2.0] * 2 + [0.0] * 2 + [-4.0])
    line = F.lit(float(weights[-1]))
    for w, x in zip(weights, _inputs({c: F.col(c) for c in FEATURES})):
        line = line + float(w) * x
    score = 1 / (1 + F.exp(-line))
    out = f.select(F.col("doc_id").cast(id_type).alias("doc_id"), "_key", "held_out", score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that :func:`toxicity` predicts to be toxic; columns and their order stay."""
    bad = toxicity(docs, labels, **options).where("predicted = 1").select(F.col("doc_id").alias("__bad_id"), F.col("_key").alias("__bad_key")).distinct()
    on = F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (text_key(F.col("text")) == F.col("__bad_key"))
    return docs.join(bad, on, "left_anti")
