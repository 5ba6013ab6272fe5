"""Token id files: one zstandard frame for each document, a shared dictionary, an offset index."""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard as zstd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tokens import encoder

END_ID = 2
#: Documents and ids of each that the dictionary is trained on; a bound, whatever the input.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 1000, 4096, 112_640
#: Bytes of text for each shard.
SHARD_BYTES = 32 << 20
LEVEL = 3
#: Shard: frames, then the index, then this footer: index offset, documents, bytes of an id, dictionary hash, mark.
FOOTER = "<QQI32s8s"
MARK = b"TOKIDS01"
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("start", "<u8"), ("tokens", "<u8"), ("offset", "<u8"), ("bytes", "<u8")])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system of a shared folder by its URI (any that pyarrow knows), so tasks can write their shards there."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _read(path: str) -> bytes:
    fs, p = _open(path)
    with fs.open_input_file(p) as f:
        return f.read()


def _publish(path: str, data: bytes) -> None:
    """Write under another name and move: a file is there whole or not at all, and a repeated task replaces it by its equal."""
    fs, p = _open(path)
    tmp = f"{p}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, p)


def train_dictionary(docs: DataFrame, vocabulary: str, id_bytes: int, docs_bound: int = SAMPLE_DOCS, ids_bound: int = SAMPLE_IDS) -> bytes:
    """Dictionary of a bounded sample: the documents with the smallest hashes, the first ids of each.

    Too few or too small samples give a plain dictionary of their bytes, none an empty one.
    """

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"ids": [i[:ids_bound].astype(f"<u{id_bytes}").tobytes() for i in encoder(vocabulary).ids(list(b["text"]))]})

    least = docs.where("text != ''").orderBy(F.xxhash64("doc_id", "text")).select(F.substr("text", F.lit(1), F.lit(8 * ids_bound)).alias("text")).limit(docs_bound)
    samples = [bytes(r.ids) for r in least.mapInPandas(each, "ids binary").collect()]
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstd.ZstdCompressionDict | None:
    return zstd.ZstdCompressionDict(data) if data else None


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, id_bytes: int | None = None, shard_bytes: int = SHARD_BYTES) -> None:
    """Writes ``docs`` (``doc_id`` integer, ``text``) below ``path``, in ascending doc_id order.

    ``dictionary`` holds the shared dictionary, ``shard-N`` the frames and index of a range of doc_ids, ``manifest.json`` the
    shards in order, the hash of the dictionary, and what the ids mean; it is written last. Each document is a frame of its own
    over its ids and the end id, as little-endian numbers of ``id_bytes`` (2 where the vocabulary allows). Rows are dealt by
    range, ties by text and place, so repeated ids spread. Null ids come first, null texts count as empty. Tasks write their shard
    and return a line for the manifest; only those lines reach the driver. Repeated tasks write the same bytes.
    """
    n_ids = encoder(vocabulary).size()
    id_bytes = id_bytes or (2 if max(n_ids - 1, end_id) < 1 << 16 else 4)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    fs, local = _open(path)
    fs.create_dir(local, recursive=True)
    dictionary = train_dictionary(d, vocabulary, id_bytes)
    digest = hashlib.sha256(dictionary).digest()
    _publish(f"{path}/dictionary", dictionary)
    shards = max(1, -(-(d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        name, enc = f"shard-{TaskContext.get().partitionId():06d}", encoder(vocabulary)
        shared = _dictionary(_read(f"{path}/dictionary"))
        if shared:
            shared.precompute_compress(level=LEVEL)  # else each frame digests it anew
        pack = zstd.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
        end, index, frames, at, start = np.array([end_id], dtype="<u4"), [], [], 0, 0
        for b in batches:
            for doc_id, null, ids in zip(b["doc_id"], b["null"], enc.ids(list(b["text"]))):
                frame = pack.compress(np.concatenate((ids, end)).astype(f"<u{id_bytes}").tobytes())
                index.append((doc_id, null, start, len(ids) + 1, at, len(frame)))
                frames.append(frame)
                at, start = at + len(frame), start + len(ids) + 1
        if index:
            footer = struct.pack(FOOTER, at, len(index), id_bytes, digest, MARK)
            _publish(f"{path}/{name}", b"".join(frames) + np.array(index, dtype=INDEX).tobytes() + footer)
            known = [int(i[0]) for i in index if not i[1]]
            yield pd.DataFrame({"name": [name], "docs": [len(index)], "tokens": [start], "first": [min(known, default=0)], "last": [max(known, default=-1)]})

    spread = d.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("at"))
    dealt = spread.repartitionByRange(int(shards), F.col("doc_id").asc_nulls_first(), "h", "at").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "at")
    rows = dealt.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().cast("int").alias("null"), "text").mapInPandas(
        each, "name string, docs bigint, tokens bigint, first bigint, last bigint").collect()
    base, lines = 0, []
    for r in sorted(rows, key=lambda r: r["name"]):
        lines.append({**r.asDict(), "start": base})
        base += r["tokens"]
    _publish(f"{path}/manifest.json", json.dumps({"format": MARK.decode(), "dictionary_sha256": digest.hex(), "id_bytes": id_bytes, "end_id": end_id, "shards": lines}).encode())


def _frames(path: str, shard: dict, dictionary_sha256: str, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
    """doc_id, first id's place in all files, and frame; with ``wanted`` only the frames of these documents are read."""
    fs, p = _open(f"{path}/{shard['name']}")
    with fs.open_input_file(p) as f:
        size = f.size()
        n_footer = struct.calcsize(FOOTER)
        at, n, id_bytes, digest, mark = struct.unpack(FOOTER, f.read_at(n_footer, size - n_footer))
        if mark != MARK or digest.hex() != dictionary_sha256:
            raise ValueError(f"{shard['name']}: not of this format or dictionary")
        index = np.frombuffer(f.read_at(n * INDEX.itemsize, at), dtype=INDEX)
        for e in index:
            doc_id = None if e["null"] else int(e["doc_id"])
            if wanted is None or doc_id in wanted:
                yield doc_id, shard["start"] + int(e["start"]), f.read_at(int(e["bytes"]), int(e["offset"]))


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of the files: ``start`` counts the ids of all documents before.

    One task for each shard, read frame by frame. With ``doc_ids`` only shards whose range holds one are opened, and only the
    frames of these documents are read, through the offset index. A shard of another format or dictionary raises.
    """
    m = json.loads(_read(f"{path}/manifest.json"))
    wanted = None if doc_ids is None else set(doc_ids)
    shards = [s for s in m["shards"] if wanted is None or any(s["first"] <= x <= s["last"] for x in wanted)]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    if not shards:
        return spark.createDataFrame([], schema)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data = _read(f"{path}/dictionary")
        if hashlib.sha256(data).hexdigest() != m["dictionary_sha256"]:
            raise ValueError("the dictionary is not that of the manifest")
        unpack = zstd.ZstdDecompressor(dict_data=_dictionary(data))
        for b in batches:
            for line in b["shard"]:
                rows = []
                for doc_id, start, frame in _frames(path, json.loads(line), m["dictionary_sha256"], wanted):
                    ids = np.frombuffer(unpack.decompress(frame), dtype=f"<u{m['id_bytes']}").astype("<u4")
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), *([ids.astype(np.int64)] if with_ids else [])))
                    if len(rows) == 2000:
                        yield _table(rows, schema)
                        rows = []
                yield _table(rows, schema)

    lines = spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shards)], "i int, shard string")
    return lines.repartition(len(shards), "i").select("shard").mapInPandas(each, schema)


def _table(rows: list[tuple], schema: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
    return out.astype({"doc_id": "Int64"})
