"""Piece encoding, spelling variants and token alignment against the libraries and plain Python, on hard cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tablesync.llm import alignment, pieces, spelling
from tablesync.llm.common import Stage
from tablesync.llm.queries import piece_vocabulary, vocabulary

from .test_operators import SCHEMA, SF, TEXTS, bag

HARD = [
    (30, "  two  spaces   three" + " " * 70 + "many" + " " * 48), (31, "▁ a▁b"), (32, "<s> <0x41> </s> <unk> <|endoftext|>"), (33, "café naïve Ã×÷ß ÿ"), (34, "你好，日本語テキスト\U0001f600\x00\x7f"),
    (35, "tab\tand\r\nline end\x1c b\n\n\nc \n d"), (36, "1234567 3.14 don't 's"), (37, "manmanman command protocol " * 40), (38, "x" * 5000), (39, "<|endoftext|>"), (40, "\n"), (41, " "),
]
ALL = TEXTS + HARD


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "w", 2, 3, "k", [1], "i", "y", 4, "t") for i, t in ALL], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=piece_vocabulary())


def le(ids):
    return np.array(ids, dtype="<u4").tobytes()


# pieces


def piece_report(library, rows):
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        out.append((i, len(ids), hashlib.sha256(le(ids)).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return out


def test_piece_report(docs, none, given, library):
    assert bag(pieces.report(docs, piece_vocabulary()).collect()) == bag(piece_report(library, ALL))
    assert pieces.report(none, piece_vocabulary()).count() == 0
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    assert bag(pieces.report(given, piece_vocabulary()).collect()) == bag(piece_report(library, rows))


def test_encode_and_decode(docs, library):
    rows = pieces.encode(docs.withColumn("ids", F.lit(1)), piece_vocabulary(), end=False)
    assert set(rows.columns) == set(docs.columns) | {"ids"}
    back = pieces.decode(rows, piece_vocabulary()).select("doc_id", "text", "ids", "decoded").collect()
    for r in back:
        assert r.ids == library.encode(r.text or "", add_bos=True) and r.decoded == library.decode(r.ids)
    assert len(back) == len(ALL)


def test_decode_of_any_ids(spark, library):
    r = random.Random(3)
    ids = [[r.choice((r.randrange(32000), r.randrange(3, 259))) for _ in range(r.randrange(9))] for _ in range(300)] + [[0], [1], []]
    rows = pieces.decode(spark.createDataFrame([(x,) for x in ids] + [(None,)], "ids array<int>"), piece_vocabulary()).collect()
    assert all(x.decoded == (None if x.ids is None else library.decode(x.ids)) for x in rows)


def test_merges_of_random_words(library):
    model, r = pieces.piece_model(piece_vocabulary()), random.Random(4)
    some = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts = ["".join(r.choice(some) for _ in range(r.randrange(1, 12))) for _ in range(1500)]
    texts += ["".join(r.choice(a) for _ in range(60)) for a in (r.sample("abcdeinrstom n  ▁", k=3) for _ in range(800))]
    texts += [" " * k + x for k in range(70) for x in ("", "the", "你")]
    for t, raw in zip(texts, model.raw_ids(texts)):
        assert np.frombuffer(raw, dtype="<u4").tolist() == library.encode(t), t


def test_caches_start_anew(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    model = pieces.PieceModel(piece_vocabulary())
    texts = [t or "" for _, t in ALL if len(t or "") < 9000]
    assert [np.frombuffer(next(model.raw_ids([t])), dtype="<u4").tolist() for t in texts] == library.encode(texts)


# spelling variants


def counts_by_hand(rows):
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    return n


def variants_by_hand(counts, letters=5, least=3):
    n = {w: c for w, c in counts.items() if len(w) >= letters and c >= least}
    alphabet = sorted({c for w in n for c in w})
    out, form = [], {}
    for w in n:
        near = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet}
        near |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        near = sorted((-n[x], x) for x in near - {w} if x in n)
        form[w] = near[0][1] if near and -near[0][0] >= 2 * n[w] else None
        out.append([w, form[w], w, n[w], len(near), n.get(form[w])])
    for row in out:
        while form[row[2]]:
            row[2] = form[row[2]]
    return [tuple(r) for r in out]


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_variants(docs, none, given):
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    want = variants_by_hand(counts_by_hand(rows))
    assert any(w[1] for w in want) and bag(spelling.spelling_variants(given).select(COLUMNS).collect()) == bag(want)
    assert bag(spelling.spelling_variants(docs).select(COLUMNS).collect()) == bag(variants_by_hand(counts_by_hand(ALL)))
    assert spelling.spelling_variants(none).count() == 0


def dictionary():
    r = random.Random(9)
    base = ["".join(r.choice("abceilnoßé×") for _ in range(r.choice((5, 6, 9, 47, 48, 49, 50)))) for _ in range(60)] + ["l" * 400, "é" * 60, "aaaaa"]
    words = dict.fromkeys(base, 100)
    for w in base:
        for _ in range(6):  # a way of edits with falling counts, ties among them
            k, n = r.randrange(len(w)), max(3, words.get(w, 3) // r.choice((1, 2, 3)))
            w = r.choice((w[:k] + w[k + 1:], w[:k] + "z" + w[k:], w[:k] + "o" + w[k + 1:], w + "a"))
            words.setdefault(w, n)
    return words


@pytest.mark.parametrize("options", [{}, {"max_filters": 1, "shard_words": 7}])
def test_variants_of_a_dictionary(spark, options):
    words = dictionary()
    rows = [(w, n - 1, 1) for w, n in words.items()] + [(w, 1, 2) for w in words] + [(None, 9, 9)]
    got = spelling.group_variants(spark.createDataFrame(rows, "word string, n bigint, m int"), **options)
    want = variants_by_hand(words)
    assert max(r[4] for r in want) > 1 and any(r[1] and r[2] != r[1] for r in want)
    assert bag(got.select(COLUMNS).collect()) == bag(want)


def test_filters_know_every_word_and_few_others():
    r = np.random.default_rng(1)
    h = r.integers(0, 1 << 63, 20000, dtype=np.uint64)
    shares = spelling.Filters.share(h, 3)
    f = spelling.Filters({7: 3}, {(7, s): spelling.Filters.build(h[shares == s]) for s in range(3)})
    assert f.holds(7, h).all() and not f.holds(8, h).any()
    assert f.holds(7, r.integers(0, 1 << 63, 100000, dtype=np.uint64)).mean() < 0.01


# alignment


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return t


def byte_level():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(other)}


def groups_by_hand(tokenizer, library, text):
    """Groups of ids and linked pairs of one text, or nothing."""
    if not text:
        return [], []
    table = byte_level()
    a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = library.encode(text)
    x = [bytes(table[c] for c in tokenizer.id_to_token(i)) for i in a]
    piece = library.id_to_piece
    y = [bytes([int(piece(i)[3:5], 16)]) if library.is_byte(i) else piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(x) == (" " + text).encode() == b"".join(y):
        return [], []
    p, q = np.cumsum([len(t) for t in x]).tolist(), np.cumsum([len(t) for t in y]).tolist()
    ends = [0] + sorted(set(p) & set(q))
    groups = [([i for i, e in zip(a, p) if s < e <= t], [i for i, e in zip(b, q) if s < e <= t]) for s, t in zip(ends, ends[1:])] if len(a) < 400 else None
    if groups is None:  # the same in one pass, for long texts
        groups, i, j = [], 0, 0
        for t in ends[1:]:
            k, m = p.index(t, i) + 1, q.index(t, j) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
    return groups, [(g[-1], h[-1]) for g, h in groups]


def alignment_by_hand(tokenizer, library, rows):
    found = [(i, *groups_by_hand(tokenizer, library, t)) for i, t in rows]
    counts = Counter(pair for _, _, links in found for pair in links)
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for i, groups, links in found:
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((
            i, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


@pytest.mark.parametrize("bound", [alignment.MAX_TABLE, 0])
def test_alignment_report(docs, none, tokenizer, library, bound):
    got = alignment.alignment_report(docs, vocabulary(), piece_vocabulary(), max_table=bound)
    assert bag(got.collect()) == bag(alignment_by_hand(tokenizer, library, ALL))
    assert alignment.alignment_report(none, vocabulary(), piece_vocabulary(), max_table=bound).count() == 0


def test_alignment_of_given_documents(given, tokenizer, library, monkeypatch):
    for name, value in (("SHARD_PAIRS", 500), ("SUM_ROWS", 200), ("FAN", 2)):  # many shards, a deep tree
        monkeypatch.setattr(alignment, name, value)
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    got = alignment.alignment_report(given.repartition(9), vocabulary(), piece_vocabulary())
    assert bag(got.collect()) == bag(alignment_by_hand(tokenizer, library, rows))


def test_pair_counts_and_groups(docs, tokenizer, library):
    want = Counter(pair for _, t in ALL for pair in groups_by_hand(tokenizer, library, t)[1])
    assert {(r.a, r.b): r.n for r in alignment.pair_counts(docs, vocabulary(), piece_vocabulary()).collect()} == want
    got = alignment.aligned(docs, vocabulary(), piece_vocabulary()).collect()
    assert bag((r.doc_id, [(g.a, g.b) for g in r.groups]) for r in got) == bag((i, groups_by_hand(tokenizer, library, t)[0]) for i, t in ALL)


def test_stretches_by_themselves(tokenizer, library):
    r, known = random.Random(8), alignment.Aligner(vocabulary(), piece_vocabulary())
    some = ["the", "Aé", "don't", "ends.", "x,", "(y)", "a-b", "3.5", "\n", "\n\n", " ", "  ", "\t", "...", "ÿ!", "Ƞz", "你好", "<s>", "_q", "$5", "'s"]
    for _ in range(3000):
        t = "".join(r.choice(some) + r.choice(("", "", " ")) for _ in range(r.randrange(1, 9)))
        row = known.of([t])[0]
        assert ";".join(known.groups[k] for k in row) == ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups_by_hand(tokenizer, library, t)[0]), t


def test_caches_of_the_aligner_start_anew(docs, tokenizer, library, monkeypatch):
    known = alignment.Aligner(vocabulary(), piece_vocabulary())
    for i, t in HARD + HARD:
        if known.full() or i % 2:
            known.clear()
        row = known.of([t])[0]
        assert ";".join(known.groups[k] for k in row) == ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups_by_hand(tokenizer, library, t)[0])


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 30000, dtype=np.uint64))
    sizes, words = alignment.perfect_hash(keys)
    table = alignment.PairTable([sizes], [words], keys)
    slots = table.find(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))
    table.keys = np.zeros_like(keys)
    table.keys[slots] = keys
    assert (table.slots(keys) == slots).all() and (table.slots(keys + np.uint64(1 << 63)) == -1).all()
    assert words.nbytes * 8 < 4 * len(keys)
