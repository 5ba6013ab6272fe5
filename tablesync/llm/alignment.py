"""Cross-tokenizer alignment: groups of tokens that end together, and corpus counts of token pairs by minimal perfect hashing."""

from __future__ import annotations

import hashlib
import re
import uuid
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from .common import Stage
from .pieces import SPACE, blocks, piece_model
from .tokens import _LETTERS, _alphabet

#: Aligned stretches of text that a worker keeps, and their characters; a full cache starts anew.
CACHE_CHUNKS, CACHE_CHARS = 1_000_000, 1 << 25
#: Distinct pairs of one hash function, rows that one task adds up, and vectors that one step of the tree adds up.
SHARD_PAIRS, SUM_ROWS, FAN = 1 << 16, 1 << 20, 16
#: The function with its keys and counts is broadcast up to this size (about 18 bytes a pair); beyond it documents' pairs are joined.
MAX_TABLE = 128 << 20
_ROOM = 1.5
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_aligners: dict[tuple[str, str], "Aligner"] = {}


def aligner(vocabulary: str, model: str) -> "Aligner":
    """The aligner of two vocabulary files, one for each worker process."""
    if (vocabulary, model) not in _aligners:
        _aligners[vocabulary, model] = Aligner(vocabulary, model)
    return _aligners[vocabulary, model]


class Aligner:
    """Aligns a byte-level BPE (A, on a space and the text) with a SentencePiece BPE (B, on the text).

    Texts are cut where neither tokenizer joins what stands on both sides: before a single space and around a single newline between
    visible characters, and between letters and marks that no piece of B holds together. Tokens of both end there, so a text's groups
    are those of its stretches. Each stretch is aligned once and kept, also from task to task.
    """

    _cut = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
    _cut_spaces = re.compile(r"(?<=\S)(?= \S)")
    _plain = re.compile(f" ?[{_LETTERS}]+")

    def __init__(self, vocabulary: str, model: str):
        self._t = Tokenizer.from_file(vocabulary)
        self._t.encode_special_tokens = True  # their strings inside a text are plain text
        self._b, self._map = piece_model(model), _alphabet()
        byte = {c: b for b, c in self._map.items()}
        added = {i: t.content.encode() for i, t in self._t.get_added_tokens_decoder().items()}
        self._bytes = [added.get(i) or bytes(byte.get(c, ord(c) & 255) for c in self._t.id_to_token(i) or "") for i in range(self._t.get_vocab_size())]
        self._len_a, self._len_b = (np.array([len(x) for x in t], dtype=np.int64) for t in (self._bytes, self._b.surface))
        # ids as text with what follows them: inside a group, at the end of its A or B side, at the end of a stretch
        self._shown = [f"{i}{end}" for i in range(max(len(self._len_a), len(self._len_b))) for end in ",|;\n"]
        apart = "".join(m for m in map(chr, range(33, 127)) if not m.isalnum() and m != "'" and not self._b.joins(_LETTERS, m))
        self._marked = re.compile(f"( ?[{_LETTERS}]+)([{re.escape(apart)}]+)") if apart else re.compile(r"(?!)")
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.n_a, self.n_b, self.groups, self.bad = array("q"), array("q"), [], set()
        self.pairs, self.stops = array("Q"), array("q", [0])  # pairs of all stretches, and where those of each end
        self.chars, self.sums, self.sums_of = 0, np.zeros((5, 0), dtype=np.int64), None
        self.room = self.sums

    def full(self) -> bool:
        return len(self.index) > CACHE_CHUNKS or self.chars > CACHE_CHARS

    def split(self, text: str) -> list[str]:
        if not self._b.newline_apart:
            return self._cut_spaces.split(" " + text)
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n" or not text.replace("\n", "").isprintable():
            return self._cut.split(" " + text)
        return (" " + text).replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")[1:]

    def learn(self, chunks: set[str]) -> None:
        """Align chunks that aren't known."""
        joined, new = [], {}
        for c in chunks:
            m = None if c[-1].isalnum() else self._marked.fullmatch(c)
            if m:
                joined.append((c, m[1], m[2]))
                new.update({x: None for x in m.groups() if x not in self.index})
            else:
                new[c] = None
        self._align(list(new))
        for c, x, y in joined:
            i, j = self.index[x], self.index[y]
            pairs = self.pairs[self.stops[i]:self.stops[i + 1]] + self.pairs[self.stops[j]:self.stops[j + 1]]
            self._keep(c, self.n_a[i] + self.n_a[j], self.n_b[i] + self.n_b[j], pairs, f"{self.groups[i]};{self.groups[j]}")

    def _keep(self, chunk: str, n_a: int, n_b: int, pairs, groups: str) -> None:
        self.index[chunk] = len(self.index)
        self.chars += len(chunk)
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.pairs.extend(pairs)
        self.stops.append(len(self.pairs))
        self.groups.append(groups)

    def _ids(self, chunk: str) -> list[int]:
        if not self._plain.fullmatch(chunk):
            return self._t.encode(chunk, add_special_tokens=False).ids
        # one word to the pre-tokenizer: its model alone is asked
        shown = chunk.replace(" ", self._map[32]) if chunk.isascii() else chunk.encode().decode("latin-1").translate(self._map)
        return [t.id for t in self._tokenize(shown)]

    def _align(self, chunks: list[str]) -> None:
        """Align all chunks at once: places where tokens end, counted through all of them, that A and B have in common."""
        if not chunks:
            return
        self._tokenize = self._t.model.tokenize
        a = [self._ids(c) for c in chunks]
        b, n_b = self._b.merged([c.replace(" ", SPACE) for c in chunks])
        n_a = np.array([len(x) for x in a], dtype=np.int64)
        a, b = np.array([i for x in a for i in x], dtype=np.int64), b.astype(np.int64)
        starts_a, starts_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        good = np.ones(len(chunks), dtype=bool)
        for k, c in enumerate(chunks):
            if not self._plain.fullmatch(c):  # plain words are spelled by both
                text = c.encode("utf-8", "surrogatepass")
                x, y = a[starts_a[k]:starts_a[k] + n_a[k]].tolist(), b[starts_b[k]:starts_b[k] + n_b[k]].tolist()
                good[k] = b"".join([self._bytes[i] for i in x]) == text == b"".join([self._b.surface[i] for i in y])
        if not good.all():
            for k in np.flatnonzero(~good):
                self.bad.add(len(self.index))
                self._keep(chunks[k], 0, 0, (), "")
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            chunks, n_a, n_b = [c for c, g in zip(chunks, good) if g], n_a[good], n_b[good]
            if not chunks:
                return
        ends_a, ends_b = np.cumsum(self._len_a[a]), np.cumsum(self._len_b[b])
        at = np.searchsorted(ends_b, ends_a)
        meet_a = ends_b[at] == ends_a
        meet_b = np.zeros(len(b), dtype=bool)
        meet_b[at[meet_a]] = True
        pairs = a[meet_a] << 32 | b[meet_b]
        met = np.concatenate(([0], np.cumsum(meet_a)))
        first = len(self.pairs)
        # the text of all groups: tokens of A, then of B, group by group
        last = np.zeros(len(b), dtype=np.int64)
        last[np.cumsum(n_b) - 1] = 1
        shown = np.concatenate((a * 4 + meet_a, b * 4 + np.where(meet_b, 2 + last, 0)))
        order = np.argsort(np.concatenate((2 * (np.cumsum(meet_a) - meet_a), 2 * (np.cumsum(meet_b) - meet_b) + 1)), kind="stable")
        groups = "".join(map(self._shown.__getitem__, shown[order].tolist())).split("\n")[:-1]
        n = len(self.index)
        self.index.update(zip(chunks, range(n, n + len(chunks))))
        self.chars += sum(map(len, chunks))
        self.n_a.frombytes(n_a.tobytes())
        self.n_b.frombytes(n_b.astype(np.int64).tobytes())
        self.pairs.frombytes(pairs.astype(np.uint64).tobytes())
        self.stops.frombytes((first + met[np.cumsum(n_a)]).astype(np.int64).tobytes())
        self.groups.extend(groups)

    def of(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the stretches of each text; none for texts without tokens."""
        cut = [self.split(t) if t else [] for t in texts]
        known = self.index
        self.learn(set(chain.from_iterable(cut)).difference(known))
        get = known.__getitem__
        out = [list(map(get, chunks)) for chunks in cut]
        return [[] if self.bad and not self.bad.isdisjoint(x) else x for x in out]

    def pairs_of(self, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of the stretches from ``first`` on, and the number of pairs of each."""
        stops = np.array(self.stops[first:], dtype=np.int64)
        return np.array(self.pairs[stops[0]:], dtype=np.uint64), np.diff(stops)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _A
    x = (x ^ (x >> np.uint64(33))) * _B
    return x ^ (x >> np.uint64(33))


def _spots(keys: np.ndarray, level: int, sizes: np.ndarray | int) -> np.ndarray:
    h = _mixed(keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64)))
    return ((h >> np.uint64(32)) * np.asarray(sizes, dtype=np.uint64) >> np.uint64(32)).astype(np.int64)


def _share(keys: np.ndarray, shares: int) -> np.ndarray:
    return (_mixed(keys + np.uint64(1)) % np.uint64(shares)).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bits of each level and the bit words of a minimal perfect hash function of distinct unsigned keys (Limasset et al., 2017).

    On each level a key that is alone at its place sets that bit; the others go to the next level. A key's number is the rank of its bit.
    """
    sizes, words, rest, level = [], [], keys, 0
    while len(rest):
        m = max(64, -(-int(len(rest) * _ROOM) // 64) * 64)
        spot = _spots(rest, level, m)
        alone = np.bincount(spot, minlength=m) == 1
        sizes.append(m)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        rest, level = rest[~alone[spot]], level + 1
    return sizes, np.concatenate(words) if words else np.zeros(0, dtype="<u8")


class PairTable:
    """Minimal perfect hash functions of all shards as one, with the keys and values in the order of their numbers."""

    def __init__(self, sizes: list[list[int]], words: list[np.ndarray], keys: np.ndarray, values: np.ndarray | None = None, top: dict[int, int] | None = None):
        levels = max((len(s) for s in sizes), default=0)
        self.sizes = np.zeros((max(len(sizes), 1), levels), dtype=np.int64)
        for k, s in enumerate(sizes):
            self.sizes[k, :len(s)] = s
        flat = self.sizes.ravel()
        self.base = (np.cumsum(flat) - flat).reshape(self.sizes.shape)
        self.words = np.concatenate(words).astype(np.uint64) if words else np.zeros(0, dtype=np.uint64)
        n = np.bitwise_count(self.words).astype(np.int64)
        self.ranks = np.cumsum(n) - n
        self.keys, self.values = keys, values
        self.top = top

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key of the table; any number or -1 for others."""
        out = np.full(len(keys), -1, dtype=np.int64)
        live, shard = np.arange(len(keys)), _share(keys, len(self.sizes))
        for level in range(self.sizes.shape[1]):
            m = self.sizes[shard[live], level]
            live, m = live[m > 0], m[m > 0]
            spot = self.base[shard[live], level] + _spots(keys[live], level, m)
            word, bit = self.words[spot >> 6], (spot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[live[hit]] = (self.ranks[spot >> 6] + below)[hit]
            live = live[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key; -1 for keys that are not in the table, which the stored keys tell."""
        out = self.find(keys)
        known = out >= 0
        known[known] = self.keys[out[known]] == keys[known]
        return np.where(known, out, -1)


def _partial_counts(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """``part, pair, n``: pairs of each task's documents, counted there; ``part`` tells tasks apart."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, part = aligner(vocabulary, model), TaskContext.get().partitionId()
        seen = np.zeros(len(known.index), dtype=np.int64)

        def counted() -> pa.RecordBatch:
            pairs, counts = known.pairs_of(0)
            times = np.repeat(seen, counts)
            keys, at = np.unique(pairs[times > 0], return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, at, times[times > 0])
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part, np.int32)), pa.array(keys.view(np.int64)), pa.array(sums)], names=["part", "pair", "n"])

        for b in batches:
            for texts in blocks(b.column(0).to_pylist()):
                if known.full():
                    yield counted()
                    known.clear()
                    seen = np.zeros(0, dtype=np.int64)
                rows = known.of(texts)
                more = np.bincount(np.fromiter((k for r in rows for k in r), dtype=np.int64), minlength=len(known.index))
                more[:len(seen)] += seen
                seen = more
        yield counted()

    return docs.select("text").mapInArrow(each, "part int, pair bigint, n bigint")


def _dealt(rows: DataFrame, shares: int) -> DataFrame:
    """``rows`` with the shard of ``pair``."""
    cols = rows.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            share = _share(b.column(cols.index("pair")).to_numpy().view(np.uint64), shares)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(share.astype(np.int32))], names=[*cols, "shard"])

    return rows.mapInArrow(each, T.StructType([*rows.schema, T.StructField("shard", T.IntegerType())]))


def _added(p: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(v, dtype="<i8") for v in p["counts"]], axis=0, dtype=np.int64)
    return pd.DataFrame({"shard": p["shard"][:1], "salt": p["salt"][:1], "counts": [total.astype("<i8").tobytes()]})


def counted_pairs(docs: DataFrame, vocabulary: str, model: str, stage: Stage) -> tuple[DataFrame, int]:
    """``shard, sizes, words, keys, counts`` and the number of shards: the hash function of each shard's distinct pairs, and their counts.

    Tasks count their own pairs first. The distinct pairs are dealt to shards by hash, each gets a minimal perfect hash function. Rows of a
    shard are added into dense vectors indexed by it, at most about ``SUM_ROWS`` of them in one task, each verified against the
    key at its place; the vectors of a shard are summed in a tree of ``FAN`` branches, so no task's input grows with the corpus.
    """
    partial = stage.write(_partial_counts(docs, vocabulary, model))
    rows = partial.count()
    keys = stage.write(partial.select("pair").distinct())
    shares = max(1, -(-keys.count() // SHARD_PAIRS))

    def build(p: pd.DataFrame) -> pd.DataFrame:
        keys = p["pair"].to_numpy(np.int64).view(np.uint64)
        sizes, words = perfect_hash(keys)
        ordered = np.zeros(len(keys), dtype="<u8")
        ordered[PairTable([sizes], [words], keys).find(keys)] = keys
        return pd.DataFrame({"shard": p["shard"][:1], "sizes": [sizes], "words": [words.tobytes()], "keys": [ordered.tobytes()]})

    functions = stage.write(_dealt(keys, shares).groupBy("shard").applyInPandas(build, "shard int, sizes array<int>, words binary, keys binary"))
    salts = max(1, -(-rows // (shares * SUM_ROWS)))

    def add(function: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        f = function.iloc[0]
        known = np.frombuffer(f["keys"], dtype="<u8")
        table = PairTable([list(f["sizes"])], [np.frombuffer(f["words"], dtype="<u8")], known)
        total = np.zeros(len(known), dtype=np.int64)
        if len(p):
            pairs = p["pair"].to_numpy(np.int64).view(np.uint64)
            at = table.find(pairs)
            if (at < 0).any() or (known[at] != pairs).any():
                raise ValueError("a pair is not in its hash function")
            np.add.at(total, at, p["n"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [f["shard"]], "salt": [f["salt"]], "counts": [total.astype("<i8").tobytes()]})

    salted = functions.select("shard", "sizes", "words", "keys", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows_of = _dealt(partial, shares).withColumn("salt", F.pmod(F.col("part"), F.lit(salts)))
    schema = "shard int, salt int, counts binary"
    sums = stage.write(salted.groupBy("shard", "salt").cogroup(rows_of.groupBy("shard", "salt")).applyInPandas(add, schema))
    while salts > 1:
        sums = stage.write(sums.withColumn("salt", F.floor(F.col("salt") / FAN).cast("int")).groupBy("shard", "salt").applyInPandas(_added, schema))
        salts = -(-salts // FAN)
    stage.drop(partial, keys)
    return functions.join(sums.select("shard", "counts"), "shard"), shares


def _as_rows(table: DataFrame) -> DataFrame:
    """``a, b, n`` of a table of :func:`counted_pairs`."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, c in zip(*(col.to_pylist() for col in batch.columns)):
                keys, counts = np.frombuffer(k, dtype="<u8"), np.frombuffer(c, dtype="<i8")
                a, b = (keys >> np.uint64(32)).astype(np.int32), (keys & np.uint64(0xFFFFFFFF)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts)], names=["a", "b", "n"])

    return table.select("keys", "counts").mapInArrow(each, "a int, b int, n bigint")


def pair_counts(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """``a, b, n``: how often tokens ``a`` and ``b`` of the two vocabularies end together in all texts."""
    stage = Stage(docs.sparkSession, "pairs")
    return _as_rows(stage.write(counted_pairs(docs, vocabulary, model, stage)[0]))


def aligned(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """``doc_id, groups``: groups of tokens of each text as ``array<struct<a: array<int>, b: array<int>>>``; empty for texts without tokens."""
    d = docs.select("doc_id", "text")
    id_type = d.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(vocabulary, model)
        ints = pa.list_(pa.int32())
        for b in batches:
            out = []
            for texts in blocks(b.column(1).to_pylist()):
                if known.full():
                    known.clear()
                for row in known.of(texts):
                    groups = [g.split("|") for k in row for g in known.groups[k].split(";")]
                    out.append([{"a": list(map(int, x.split(","))), "b": list(map(int, y.split(",")))} for x, y in groups])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.struct([("a", ints), ("b", ints)])))], names=["doc_id", "groups"])

    return d.mapInArrow(each, f"doc_id {id_type}, groups array<struct<a: array<int>, b: array<int>>>")


_REPORT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _digests(d: DataFrame, vocabulary: str, model: str, lookup) -> DataFrame:
    """The report of each row; ``lookup`` is a broadcast table, or null for rows that carry their ``pairs`` and ``times`` instead of sums."""
    id_type = d.schema["doc_id"].dataType.simpleString()
    token = uuid.uuid4().hex
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + ([] if lookup else ["pairs", "times"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(vocabulary, model)
        table = PairTable(*lookup.value) if lookup else None
        top = np.zeros(1, dtype=np.int64)
        if table and table.top:
            top = np.zeros(max(table.top) + 1, dtype=np.int64)
            top[list(table.top)] = list(table.top.values())
        if known.sums_of != token:  # what an earlier task of this query found for the stretches stays
            known.sums = known.room = np.zeros((5, 0), dtype=np.int64)
            known.sums_of = token

        def more() -> None:
            first = known.sums.shape[1]
            pairs, counts = known.pairs_of(first)
            if not len(counts):
                return
            best = total = np.zeros(len(pairs), dtype=np.int64)
            if table:
                at = table.slots(pairs)
                total = np.where(at >= 0, table.values[at], 0) if len(table.values) else best  # stretches of other queries may hold other pairs
                best = total == top[np.minimum(pairs & np.uint64(0xFFFFFFFF), np.uint64(len(top) - 1)).astype(np.int64)]
            starts = np.minimum(np.cumsum(counts) - counts, len(pairs))
            add = lambda x: np.add.reduceat(np.append(x.astype(np.int64), 0), starts) * (counts > 0)
            new = [np.array(known.n_a[first:]), np.array(known.n_b[first:]), counts, add(best), add(total)]
            n = first + len(counts)
            if n > known.room.shape[1]:
                known.room = np.concatenate((known.sums, np.zeros((5, n + 1000), dtype=np.int64)), axis=1)
            known.room[:, first:n] = new
            known.sums = known.room[:, :n]

        for b in batches:
            out: list[list] = [[] for _ in names[1:]]
            for texts in blocks(b.column(1).to_pylist()):
                if known.full():
                    known.clear()
                    known.sums_of = token
                rows = known.of(texts)
                more()
                for row in rows:
                    n_a, n_b, n, best, total = known.sums[:, row].sum(axis=1).tolist() if row else (0, 0, 0, 0, 0)
                    digest = hashlib.sha256(";".join([known.groups[k] for k in row]).encode()).hexdigest() if row else ""
                    values = [n_a, n_b, n, n, best, total, digest]
                    if not lookup:
                        pairs, times = np.unique(np.array([p for k in row for p in known.pairs[known.stops[k]:known.stops[k + 1]]], dtype=np.int64), return_counts=True)
                        values += [pairs, times]
                    for o, v in zip(out, values):
                        o.append(v)
            types = [pa.int64()] * 6 + [pa.string()] + ([] if lookup else [pa.list_(pa.int64())] * 2)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(o, t) for o, t in zip(out, types))], names=names)

    return d.select("doc_id", "text").mapInArrow(each, f"doc_id {id_type}, {_REPORT}" + ("" if lookup else ", pairs array<bigint>, times array<bigint>"))


def alignment_report(docs: DataFrame, vocabulary: str, model: str, max_table: int = MAX_TABLE) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``vocabulary`` (A) is a byte-level BPE of the tokenizers library that gets a space and the text, ``model`` (B) a SentencePiece BPE that gets the
    text; files lie at the same path on every worker. Tokens of both that end at one byte are linked. The first pass counts each linked pair
    over all documents (:func:`counted_pairs`); the second aligns the documents again and looks the counts up: ``count_sum`` adds
    them over a document's links, ``n_best`` counts links whose count is the highest of their B token. Null and empty texts and those whose tokens
    don't spell them (U+2581 is a space to B) have no tokens: zeros and an empty digest. Repeated rows are documents of their own,
    null ids stay, other columns are ignored, no rows give no rows. The table of counts is broadcast if its counted pairs
    need at most ``max_table`` bytes; else each document's distinct pairs are joined with it.
    """
    spark, stage = docs.sparkSession, Stage(docs.sparkSession, "alignment")
    d = docs.select("doc_id", "text")
    table, shares = counted_pairs(d, vocabulary, model, stage)
    table = stage.write(table)
    pairs = _as_rows(table)
    top = stage.write(pairs.groupBy("b").agg(F.max("n").alias("top")))  # a row for each token of B
    size = table.agg(F.coalesce(F.sum(F.octet_length("words") * F.lit(2) + F.octet_length("keys") + F.octet_length("counts")), F.lit(0))).first()[0]
    if size <= max_table:
        rows = sorted(table.collect(), key=lambda r: r.shard)
        by_shard = {r.shard: r for r in rows}
        held = [by_shard.get(k) for k in range(shares)]
        joined = lambda name, kind: np.frombuffer(b"".join(bytes(r[name]) for r in rows), dtype=kind)
        words = [np.frombuffer(bytes(r["words"]), dtype="<u8") if r else np.zeros(0, dtype="<u8") for r in held]
        lookup = spark.sparkContext.broadcast(([list(r["sizes"]) if r else [] for r in held], words, joined("keys", "<u8"), joined("counts", "<i8"), {r.b: r.top for r in top.collect()}))
        return _digests(d, vocabulary, model, lookup)
    report = stage.write(_digests(d, vocabulary, model, None).withColumn("_row", F.monotonically_increasing_id()))
    links = report.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("_row", F.shiftright("x.pairs", 32).cast("int").alias("a"), F.expr("cast(x.pairs & 4294967295L as int)").alias("b"), F.col("x.times").alias("times"))
    found = links.join(pairs, ["a", "b"]).join(top, "b").groupBy("_row").agg(F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    out = report.drop("n_best", "count_sum", "pairs", "times").join(found, "_row", "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
