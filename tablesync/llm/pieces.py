"""SentencePiece encoding and decoding: byte-pair merges of many words at once, in vectorised rounds."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from sentencepiece import SentencePieceProcessor

SPACE = "▁"
#: Encoded words that a worker keeps (about 200 bytes each) and their characters; a full cache starts anew.
CACHE_WORDS, CACHE_CHARS = 1_000_000, 1 << 25
#: Characters of unknown words that are merged together, unless one word alone is longer.
CHUNK = 1 << 20
_NEVER = np.int64(1) << 40
_models: dict[str, "PieceModel"] = {}


def piece_model(path: str) -> "PieceModel":
    """The model of a file, one for each worker process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def blocks(texts: list[str | None], chars: int = CHUNK) -> Iterator[list[str | None]]:
    """The texts in lists of about so many characters."""
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t or "")
        if size > chars:
            yield some
            some, size = [], 0
    if some:
        yield some


def _each_byte(e: UnicodeError) -> tuple[str, int]:
    return "�", e.start + 1


codecs.register_error("tablesync-each-byte", _each_byte)


class PieceModel:
    """Ids of a SentencePiece BPE model with byte fallback, a space before the text and no normalisation.

    ``merge`` is the encoder: the symbols of all words lie in one flat array. In each round every word merges the pair of its best rank
    wherever it stands, leftmost first, as long as a merge doesn't give birth to a pair that would go before the rest; then the
    array is compacted and finished words leave it. Words end where no piece of the vocabulary holds the two characters side by side,
    so no merge crosses their borders. Ids are those that the library gives; a model for which they aren't is refused.
    """

    def __init__(self, path: str):
        sp = SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
        byte = np.array([sp.is_byte(i) for i in range(n)])
        text = [sp.id_to_piece(i) for i in range(n)]
        score = np.array([sp.get_score(i) for i in range(n)])
        if byte.sum() != 256 or special[byte].any():
            raise ValueError(f"{path}: a BPE model with byte fallback is needed")
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        self.surface = [b"" if s else bytes([int(t[3:5], 16)]) if b else t.replace(SPACE, " ").encode() for t, b, s in zip(text, byte, special)]
        self._opens = {i for i in range(n) if not special[i] and not byte[i] and text[i].startswith(SPACE)}
        self.surface[sp.unk_id()] = sp.decode([sp.unk_id()]).encode()
        self._silent = set(np.flatnonzero(special).tolist()) - {sp.unk_id()}
        normal = {text[i]: i for i in range(n) if not special[i] and not byte[i]}
        # symbols: pieces by their id, then characters that only stand inside pieces
        inner = sorted({c for p in normal for c in p} - normal.keys())
        symbol = normal | {c: n + k for k, c in enumerate(inner)}
        self._of_char = np.full(0x110000, -1, dtype=np.int64)
        for c, i in symbol.items():
            if len(c) == 1:
                self._of_char[ord(c)] = i
        self._size = n
        order = np.unique(-score, return_inverse=True)[1]  # equal scores have equal ranks
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = symbol.get(p[:k]), symbol.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (i, order[i])
        self._pairs = np.array(sorted(pairs) + [np.iinfo(np.int64).max], dtype=np.int64)
        found = [pairs[k] for k in self._pairs[:-1].tolist()] + [(0, _NEVER)]
        self._piece, self._rank = (np.array(x, dtype=np.int64) for x in zip(*found))
        beside = {p[k:k + 2] for p in normal for k in range(len(p) - 1)}
        self._beside = np.array(sorted(symbol[x[0]] << 32 | symbol[x[1]] for x in beside), dtype=np.int64)
        self._before: dict[str, list[str]] = {}
        for x in beside:
            self._before.setdefault(x[1], []).append(x[0])
        apart = "" if any("\n" in x for x in beside) else "\n"
        run = f"{SPACE}+" if not any(x[1] == SPACE and x[0] != SPACE for x in beside) else None
        #: Cuts a text into words that are looked up in the cache; finer cuts follow inside ``merge``.
        self.words = re.compile(f"{run}[^{SPACE}{apart}]*|[^{SPACE}{apart}]+" + (f"|{apart}" if apart else "")).findall if run else lambda t: [t]
        self.newline_apart = bool(apart)
        self._cache: dict[str, bytes] = {}
        self._cached_chars = self._run = 0
        self._run = self._longest_run(normal)
        probes = ["", " ", "a", "The quick  brown fox\n\tjumps!", " " * 50 + "x " + " " * 33, "été 你好 \U0001f600 अन naïve", "<s> <0x41> 1234567", "commandcommand manman protocol"]
        if any(self.ids(t).tolist() != sp.encode(t) or self.decode(self.ids(t)) != sp.decode(sp.encode(t)) for t in probes):
            raise ValueError(f"{path}: only BPE models with byte fallback, a space in front and no normalisation are known")

    def joins(self, letters: str, mark: str) -> bool:
        """Whether a piece holds one of the ``letters`` (a regular expression's set) in front of the mark."""
        return any(re.match(f"[{letters}]", x) for x in self._before.get(mark, ()))

    def _longest_run(self, normal: dict[str, int]) -> int:
        """Length at which runs of spaces fall apart into equal pieces from their start on; 0 where they don't."""
        most = max((len(p) for p in normal if set(p) == {SPACE}), default=0)
        if most < 2:
            return 0
        ids = self.merge([SPACE * k for k in range(3 * most + 1)])
        whole = ids[most]
        return most if len(whole) == 4 and all(ids[k] == whole + ids[k - most] for k in range(most + 1, 3 * most + 1)) else 0

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and rank of each pair of symbols."""
        key = a << 32 | b
        at = np.searchsorted(self._pairs, key)
        hit = self._pairs[at] == key
        return np.where(hit, self._piece[at], -1), np.where(hit, self._rank[at], _NEVER)

    def _starts(self, sym: np.ndarray, char: np.ndarray, word: np.ndarray) -> np.ndarray:
        """First symbols of the stretches that no merge crosses."""
        key = sym[:-1] << 32 | sym[1:]
        at = np.minimum(np.searchsorted(self._beside, key), len(self._beside) - 1)
        first = np.concatenate(([True], (self._beside[at] != key) | (word[1:] != word[:-1])))
        if self._run:
            space = char == ord(SPACE)
            begins = space & np.concatenate(([True], ~space[:-1] | (word[1:] != word[:-1])))
            since = np.arange(len(sym)) - np.maximum.accumulate(np.where(begins, np.arange(len(sym)), 0))
            first |= space & (since % self._run == 0)
        return first

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word as unsigned little-endian 32-bit numbers; spaces are written as U+2581, nothing is put in front."""
        ids, counts = self.merged(words)
        flat, stops = ids.tobytes(), (np.cumsum(counts) * 4).tolist()
        return [flat[a:b] for a, b in zip([0] + stops[:-1], stops)]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        raw = "".join(words).encode("utf-32-le", "surrogatepass")
        char = np.frombuffer(raw, dtype="<u4").astype(np.int64)
        if not len(char):
            return np.zeros(0, dtype="<u4"), np.zeros(len(words), dtype=np.int64)
        of_word = np.repeat(np.arange(len(words)), lengths)
        sym = self._of_char[char]
        final = sym.copy()  # the symbol that starts at each character; -2 inside of one
        at = np.arange(len(sym))
        seg = np.cumsum(self._starts(sym, char, of_word)) - 1
        rank = np.full(len(sym), _NEVER, dtype=np.int64)
        into = np.full(len(sym), -1, dtype=np.int64)
        inside = np.flatnonzero(seg[:-1] == seg[1:])
        into[inside], rank[inside] = self._look(sym[inside], sym[inside + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(seg)))
            best = np.repeat(best, sizes)
            live = best < _NEVER
            if not live.all():  # finished words leave
                final[at[~live]] = sym[~live]
                sym, at, seg, rank, into, best = (x[live] for x in (sym, at, seg, rank, into, best))
                if not len(sym):
                    break
            # places of the best pair; of overlapping ones every other, from the left
            here = rank == best
            spot = np.arange(len(sym))
            begins = here & ~np.concatenate(([False], here[:-1]))
            run = np.maximum.accumulate(np.where(begins, spot, 0))
            i = np.flatnonzero(here & ((spot - run) % 2 == 0))
            z, r = into[i], best[i]
            # a merge beside which a pair of no worse rank appears is the last one of its word in this round
            joined = np.concatenate(([False], i[1:] == i[:-1] + 2)) & np.concatenate(([False], seg[i[1:]] == seg[i[:-1]]))
            left = np.where(joined, np.concatenate(([0], z[:-1])), sym[i - 1])
            _, before = self._look(left, z)
            before[(i == 0) | (seg[i - 1] != seg[i])] = _NEVER
            beyond = np.minimum(i + 2, len(sym) - 1)
            _, after = self._look(z, sym[beyond])
            after[(i + 2 >= len(sym)) | (seg[beyond] != seg[i])] = _NEVER
            early = (np.minimum(before, after) <= r).astype(np.int64)
            if early.any():
                so_far = np.cumsum(early) - early
                fresh = np.concatenate(([True], seg[i[1:]] != seg[i[:-1]]))
                i, z = (x[so_far == np.maximum.accumulate(np.where(fresh, so_far, 0))] for x in (i, z))
            sym[i] = z
            keep = np.ones(len(sym), dtype=bool)
            keep[i + 1] = False
            final[at[i + 1]] = -2
            p = i - np.arange(len(i))  # place of each merged symbol after compaction
            sym, at, seg, rank, into = (x[keep] for x in (sym, at, seg, rank, into))
            # pairs with a merged symbol are looked up again
            touched = np.zeros(len(sym), dtype=bool)
            touched[p] = True
            touched[p[p > 0] - 1] = True
            q = np.flatnonzero(touched)
            nxt = np.minimum(q + 1, len(sym) - 1)
            same = (q + 1 < len(sym)) & (seg[q] == seg[nxt])
            piece, found = self._look(sym[q], sym[nxt])
            into[q], rank[q] = np.where(same, piece, -1), np.where(same, found, _NEVER)
        return self._emit(final, char, lengths, of_word)

    def _emit(self, final: np.ndarray, char: np.ndarray, lengths: np.ndarray, of_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(final != -2)
        sym, word, c = final[ends], of_word[ends], char[ends]
        plain = (sym >= 0) & (sym < self._size)
        if plain.all():
            ids, counts = sym, np.bincount(word, minlength=len(lengths))
        else:  # characters outside the vocabulary are written as their bytes
            each = [chr(x).encode("utf-8", "surrogatepass") for x in c[~plain].tolist()]
            size = np.ones(len(sym), dtype=np.int64)
            size[~plain] = [len(x) for x in each]
            ids = np.repeat(np.where(plain, sym, 0), size)
            ids[np.repeat(~plain, size)] = self.byte_ids[np.frombuffer(b"".join(each), dtype=np.uint8)]
            counts = np.bincount(np.repeat(word, size), minlength=len(lengths))
        return ids.astype("<u4"), counts

    def learn(self, words: Iterable[str]) -> None:
        """Put the words that are not in the cache there, many at a time."""
        if len(self._cache) > CACHE_WORDS or self._cached_chars > CACHE_CHARS:
            self._cache.clear()
            self._cached_chars = 0
        some, size = [], 0
        for w in {w for w in words if w not in self._cache}:
            some.append(w)
            size += len(w)
            self._cached_chars += len(w)
            if size > CHUNK:
                self._cache.update(zip(some, self.merge(some)))
                some, size = [], 0
        if some:
            self._cache.update(zip(some, self.merge(some)))

    def raw_ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as bytes (unsigned, little-endian, 32 bits), without begin and end; null is empty."""
        for some in blocks(texts):
            cut = [self.words((SPACE + t).replace(" ", SPACE)) if t else [] for t in some]
            self.learn(w for words in cut for w in words)
            get = self._cache.__getitem__
            for words in cut:
                yield b"".join(map(get, words))

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(next(self.raw_ids([text])), dtype="<u4")

    def raw_text(self, ids: np.ndarray) -> bytes:
        """Text of ids in UTF-8: control ids are silent, the space in front goes, bytes that are no UTF-8 become U+FFFD each."""
        if len(ids) and int(ids.max()) >= self._size:
            raise IndexError(f"ids reach from 0 to {self._size - 1}")
        listed = ids.tolist()
        out = b"".join(map(self.surface.__getitem__, listed))
        opens = next((i for i in listed if i not in self._silent), None)
        if opens in self._opens:
            out = out[1:]
        try:
            out.decode()
            return out
        except UnicodeDecodeError:
            return out.decode("utf-8", "tablesync-each-byte").encode()

    def decode(self, ids: np.ndarray) -> str:
        return self.raw_text(np.asarray(ids)).decode()


def _whole(model: PieceModel, begin: bool, end: bool) -> tuple[bytes, bytes]:
    mark = lambda i, on: np.array([i], dtype="<u4").tobytes() if on else b""
    return mark(model.begin, begin), mark(model.end, end)


def encode(docs: DataFrame, model: str, begin: bool = True, end: bool = True) -> DataFrame:
    """``docs`` with ``ids`` (array of integers, replaces a column of that name): the ids of ``text``.

    ``model`` is a model file that lies at the same path on every worker. A null or empty text has no ids but the begin and end marks.
    Each row is encoded by itself: no shuffle, any number of rows, repeated rows and null ids included. Memory follows the longest text
    and the cache of words, not the rows.
    """
    cols = [c for c in docs.columns if c != "ids"]
    d = docs.select(*[f"`{c}`" for c in cols])
    at = cols.index("text")
    schema = T.StructType([*d.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        a, b = _whole(m, begin, end)
        for batch in batches:
            ids = [np.frombuffer(a + x + b, dtype="<i4") for x in m.raw_ids(batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*cols, "ids"])

    return d.mapInArrow(each, schema)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``decoded`` (replaces a column of that name): the text of the array ``ids``. Null ids give a null text."""
    cols = [c for c in rows.columns if c != "decoded"]
    d = rows.select(*[f"`{c}`" for c in cols])
    at = cols.index("ids")
    schema = T.StructType([*d.schema, T.StructField("decoded", T.StringType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        for batch in batches:
            text = [None if x is None else m.decode(np.array([i for i in x if i is not None], dtype=np.int64)) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*cols, "decoded"])

    return d.mapInArrow(each, schema)


def report(docs: DataFrame, model: str, begin: bool = True, end: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row: digests of what :func:`encode` and :func:`decode` give.

    The ids stay inside the task, so the table of ids is neither written nor sent. Other columns are ignored.
    """
    d = docs.select("doc_id", "text")
    id_type = d.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = piece_model(model)
        a, b = _whole(m, begin, end)
        for batch in batches:
            n, ids, text = [], [], []
            for x in m.raw_ids(batch.column(1).to_pylist()):
                raw = a + x + b
                n.append(len(raw) // 4)
                ids.append(hashlib.sha256(raw).hexdigest())
                text.append(hashlib.sha256(m.raw_text(np.frombuffer(raw, dtype="<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return d.mapInArrow(each, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
