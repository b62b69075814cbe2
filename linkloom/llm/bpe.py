"""Byte-level BPE: a global shuffle of distinct words, each encoded once, and ids joined back by position.

Texts are cut into chunks of bounded size. A chunk's pre-tokens become one array of word numbers in text order, the explode
with positions in compact form, and a dictionary of its distinct words. Dictionaries are shuffled by word, so that equal
words of all chunks meet in one bucket and are encoded once; the ids return to their chunks, and each text is reassembled
by gathering ids in position order. Decoding joins ids with the token-byte table of the vocabulary file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib  # crc32 only
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text in a chunk; a longer text is a chunk of its own.
CHUNK = 20_000_000
#: Bytes of text that a bucket of distinct words may stand for, and that a task may reassemble.
BUCKET_BYTES, PART_BYTES = 1 << 30, 64 << 20
CHUNK_SCHEMA = "chunk long, bucket int, payload binary"
OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def vocabulary(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a .tiktoken file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Ragged:
    """Byte strings end to end, gathered by number."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        self.data, self.starts, self.sizes = data, np.concatenate(([0], ends[:-1])), np.diff(ends, prepend=0)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen pieces end to end, and where each ends."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.data[at], ends


@lru_cache(maxsize=2)
def _bytes_of(path: str) -> _Ragged:
    """The token-byte table: ids are dense from 0."""
    table = sorted((rank, token) for token, rank in vocabulary(path).items())
    tokens = [b""] * (table[-1][0] + 1)
    for rank, token in table:
        tokens[rank] = token
    return _Ragged(np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum([len(t) for t in tokens]))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=vocabulary(path), special_tokens={})


def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    parts = [a.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=9).compress(b"".join([np.array([len(parts), *map(len, parts)], dtype=np.int64).tobytes(), *parts]))


def _unpack(payload: bytes, *kinds) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    n = int(np.frombuffer(raw, dtype=np.int64, count=1)[0])
    sizes, at, out = np.frombuffer(raw, dtype=np.int64, count=n, offset=8), 8 * (n + 1), []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, dtype=kind, count=size // np.dtype(kind).itemsize, offset=at))
        at += size
    return out


def _chunked(batches: Iterator[pa.RecordBatch], pattern: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """For each chunk: a row with bucket -1 (ids, words of each text, word numbers), and rows with the words of each bucket."""
    import regex
    from pyspark import TaskContext

    find, chunk = regex.compile(pattern).findall, TaskContext.get().partitionId() << 32
    ids, counts, numbers, known, size = [], [], [], {}, 0

    def rows() -> pa.RecordBatch:
        words, flat = [w.encode() for w in known], np.concatenate(numbers)
        order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")  # frequent words get small numbers, which pack well
        place = np.empty(len(words), dtype=np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        flat = place[flat]
        out = [(-1, _pack(np.array([i is None for i in ids]), np.array([i or 0 for i in ids], dtype=np.int64), np.array(counts, dtype=np.int64), flat.astype(np.uint16), (flat >> 16).astype(np.uint16)))]
        bucket = np.array([zlib.crc32(words[k]) % buckets for k in order.tolist()], dtype=np.int64)
        by = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            own = by[cuts[b] : cuts[b + 1]]  # numbers, ascending
            named = [words[k] for k in order[own].tolist()]
            out.append((b, _pack(np.diff(own, prepend=0).astype(np.uint32), np.frombuffer(b"".join(named), dtype=np.uint8), np.array([len(w) for w in named], dtype=np.uint32))))
        return pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(out), pa.int64()), "bucket": pa.array([b for b, _ in out], pa.int32()), "payload": pa.array([p for _, p in out], pa.binary())})

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and size + len(text) > CHUNK:
                yield rows()
                chunk += 1
                ids, counts, numbers, known, size = [], [], [], {}, 0
            words = find(text)
            ids.append(doc_id)
            counts.append(len(words))
            new = len(known)
            for w in words:  # numbers words as they first come
                if w not in known:
                    known[w] = new
                    new += 1
            numbers.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
            size += len(text)
    if ids:
        yield rows()


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    """Words of a bucket -> ids. Rows come sorted by bucket; a word is encoded where it first comes up, and remembered while its bucket lasts."""
    piece, memo, now = _encoder(path, pattern)._core_bpe.encode_single_piece, {}, None
    for batch in batches:
        out = []
        for bucket, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if bucket >= 0:
                if bucket != now:
                    memo, now = {}, bucket
                steps, data, sizes = _unpack(payload, np.uint32, np.uint8, np.uint32)
                raw, ids, start = data.tobytes(), [], 0
                for end in np.cumsum(sizes).tolist():
                    word = raw[start:end]
                    if word not in memo:
                        memo[word] = np.array(piece(word), dtype="<u4").tobytes()
                    ids.append(memo[word])
                    start = end
                flat = np.frombuffer(b"".join(ids), dtype=np.uint32)
                payload = _pack(steps, flat.astype(np.uint16), (flat >> 16).astype(np.uint16), np.array([len(x) // 4 for x in ids], dtype=np.uint32))
            out.append(payload)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["chunk", "bucket", "payload"])


def _texts(table: pa.Table) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of a chunk's texts in their order."""
    rows = sorted(zip(table.column("bucket").to_pylist(), range(table.num_rows), strict=True))
    payload = table.column("payload")
    data, sizes, places, header = [], [], [], None
    for bucket, k in rows:
        if bucket < 0:
            header = _unpack(payload[k].as_py(), bool, np.int64, np.int64, np.uint16, np.uint16)
        else:
            steps, low, high, n = _unpack(payload[k].as_py(), np.uint32, np.uint16, np.uint16, np.uint32)
            data.append(low.astype(np.uint32) | (high.astype(np.uint32) << 16))
            sizes.append(n.astype(np.int64))
            places.append(np.cumsum(steps.astype(np.int64)))
    null, doc_ids, counts, low, high = header
    flat, at = low.astype(np.uint32) | (high.astype(np.uint32) << 16), 0
    words = None
    if data:  # numbers run over the buckets; row is where a number's ids are
        words, where = _Ragged(np.concatenate(data), np.cumsum(np.concatenate(sizes))), np.concatenate(places)
        row = np.empty(len(where), dtype=np.uint32)
        row[where] = np.arange(len(where), dtype=np.uint32)
        flat = row[flat]
    for missing, doc_id, count in zip(null.tolist(), doc_ids.tolist(), counts.tolist(), strict=True):
        yield None if missing else doc_id, words.gather(flat[at : at + count])[0] if count else np.empty(0, dtype=np.uint32)
        at += count


def encoded_chunks(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(chunk, bucket, payload): for each chunk its texts' word numbers, and the ids of its words; dealt out by chunk.

    A task that encodes holds the distinct words of one bucket, one that reassembles holds one chunk. Buckets are as many as
    shuffle partitions, and more if a bucket would stand for over BUCKET_BYTES of text; chunks go to as many partitions as
    leave each some PART_BYTES. A frequent word is one entry for each chunk, however often it stands there.
    """
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")).cast("long"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, -(-total // BUCKET_BYTES))
    cut = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(lambda b: _chunked(b, pattern, buckets), CHUNK_SCHEMA)
    dealt = cut.repartition(buckets, F.when(F.col("bucket") < 0, F.col("chunk")).otherwise(F.col("bucket").cast("long"))).sortWithinPartitions("bucket")
    return dealt.mapInArrow(lambda b: _encoded(b, path, pattern), CHUNK_SCHEMA).repartition(max(partitions, -(-total // PART_BYTES)), "chunk")


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every text.

    Ids are those of the tiktoken library for the same file and pattern, without special tokens. Null texts count as empty and have
    no ids; repeated rows come out as often as they come in; a null doc_id stays null; an empty table gives no rows; other
    columns are not read. doc_id is read as a bigint; a text id that is no number is an error under ANSI mode. A text is never
    cut: one over CHUNK is a chunk of its own, whose task holds it whole.
    """

    def assemble(table: pa.Table) -> pa.Table:
        rows = list(_texts(table))
        return pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "ids": pa.array([x.astype(np.int32) for _, x in rows], pa.list_(pa.int32()))})

    return encoded_chunks(docs, path, pattern).groupBy("chunk").applyInArrow(assemble, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded (binary) of ids; null ids count as none; an id that the table lacks raises an error.

    The token-byte table has as many rows as the vocabulary file, which bounds what each worker holds.
    """

    @F.pandas_udf("binary")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _bytes_of(path)
        for ids in batches:
            yield ids.map(lambda x: b"" if x is None or not len(x) else table.gather(np.asarray(x, dtype=np.int64))[0].tobytes())

    return tokens.select("doc_id", joined("ids").alias("decoded"))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text: encode and decode inside the chunks, without the ids
    passing through the JVM. Edge cases as in encode()."""

    def assemble(table: pa.Table) -> pa.Table:
        tokens, rows = _bytes_of(path), []
        for doc_id, ids in _texts(table):
            rows.append((doc_id, len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(tokens.gather(ids)[0].tobytes()).hexdigest()))
        return pa.table({n: pa.array([r[k] for r in rows], kind) for k, (n, kind) in enumerate((("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())))})

    return encoded_chunks(docs, path, pattern).groupBy("chunk").applyInArrow(assemble, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
