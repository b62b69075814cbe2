"""Repeated byte strings by hash-compared suffix sorting.

A byte goes if a string of LENGTH bytes over it also starts earlier. Sorting the suffixes of a whole corpus would move every
position, so positions are first narrowed without losing any: in each window of LENGTH bytes the k-gram with the smallest
hash is its anchor. The choice depends on the window's bytes only, so equal windows have equal anchors at equal offsets. Windows
whose anchor occurs once in the corpus repeat nowhere. The others travel as segments, runs of windows with one anchor,
to the bucket of their anchor. There the suffixes at equal offsets from equal anchors are merge-sorted: a comparison finds
the common extension of two suffixes by binary search over prefix polynomial hashes, so it takes logarithmic time. Neighbours
that agree in LENGTH bytes are verified byte by byte; in each class of equal windows all but the earliest are marked.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, whole_text

LENGTH = 100
GRAM = 32
#: Bytes of text in a chunk, in one hashing step, and windows in one sorting step.
CHUNK, STEP, WINDOWS = 4_000_000, 200_000, 120_000
#: Buckets for each shuffle partition: a bucket is sorted in one piece, so this bounds a task's memory.
BUCKETS = 4
#: Bytes of text for a partition at most, whatever the session's number of them.
PART_BYTES = 64 << 20
#: An anchor that occurs more often is hot: its windows travel one by one to the bucket of their own hash.
HOT = 3_000
BASE, MIX = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xBF58476D1CE4E5B9)
LAST = (1 << 63) - 1
PACKED = "bucket long, chunk long, payload binary"
PACKED_ARROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("payload", pa.binary())])
SEGMENT = np.dtype([("key", "<u8"), ("oid", "<i8"), ("tie", "<i8"), ("low", "<i8"), ("anchor", "<i8"), ("n", "<i4"), ("chunk", "<i8")])
SPAN = np.dtype([("oid", "<i8"), ("tie", "<i8"), ("start", "<i8"), ("end", "<i8")])


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64, for i < n."""
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, np.uint64(pow(int(BASE), -1, 1 << 64)), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Prefixes:
    """Prefix polynomial hashes of a buffer: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        n = 1 << max(10, int(len(data)).bit_length())
        self.up, self.down = _powers(n)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def hashes(self, at: np.ndarray, n) -> np.ndarray:
        return (self.sums[at + n] - self.sums[at]) * self.down[at]

    def every(self, n: int) -> np.ndarray:
        """The mixed hash of each substring of n bytes."""
        h = (self.sums[n:] - self.sums[:-n]) * self.down[: len(self.sums) - n]
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
        return h


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of length bytes the place of its leftmost k-gram with the smallest hash; and all k-gram hashes."""
    h = Prefixes(data).every(gram)
    value, place, width, want = h, np.arange(len(h), dtype=np.int32), 1, length - gram + 1
    while width < want:
        step = min(width, want - width)
        left, right = value[:-step], value[step:]
        first = left <= right
        place = np.where(first, place[:-step], place[step:])
        value = np.minimum(left, right)
        width += step
    return place, h


def _steps(table: pa.Table, skip: set[tuple[int, int]], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Texts of a chunk end to end, some STEP bytes at a time: the bytes, and (oid, tie, start, end) of each text that can hold a window. Equal rows come once."""
    texts, rows, size, seen = [], [], 0, set(skip)
    for doc_id, tie, body in zip(table.column("doc_id").to_pylist(), table.column("tie").to_pylist(), table.column("body"), strict=True):
        key = (LAST if doc_id is None else doc_id, tie)
        data = body.as_buffer()
        if key in seen or len(data) < length:
            continue
        seen.add(key)
        if texts and size + len(data) > STEP:
            yield np.concatenate(texts), rows
            texts, rows, size = [], [], 0
        texts.append(np.frombuffer(data, dtype=np.uint8))
        rows.append((*key, size, size + len(data)))
        size += len(data)
    if texts:
        yield np.concatenate(texts), rows


def _copies(right: pa.Table) -> set[tuple[int, int]]:
    """(oid, tie) of rows whose whole text stands in an earlier row."""
    out = set()
    for kind, payload in zip(right.column("kind").to_pylist(), right.column("payload").to_pylist(), strict=True):
        if kind == 0:
            out |= set(map(tuple, np.frombuffer(payload, dtype="<i8").reshape(-1, 2).tolist()))
    return out


def _segments(data: np.ndarray, rows: list, length: int, gram: int):
    """Runs of windows with one anchor: first window, number of windows, anchor and number of its text; and the hashes."""
    place, h = anchors(data, length, gram)
    starts, ends = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    n = ends - starts - length + 1
    own = np.repeat(np.arange(len(rows)), n)
    window = np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)
    at = place[window].astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (own[1:] != own[:-1]))))
    return window[new], np.diff(np.append(new, len(window))), at[new], own[new], h


def _dealt(rows: dict[int, bytes], chunk: int) -> pa.Table:
    return pa.table({"bucket": list(rows), "chunk": [chunk] * len(rows), "payload": list(rows.values())}, schema=PACKED_ARROW)


def _by_bucket(buckets: np.ndarray):
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order], prepend=-1, append=-1))
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(buckets[order[a]]), order[a:b]


def chunk_anchors(chunk: int, left: pa.Table, right: pa.Table, buckets: int, length: int, gram: int) -> pa.Table:
    """The anchors of a chunk and how often each occurs, dealt out by anchor."""
    found = []
    for data, rows in _steps(left, _copies(right), length):
        _, _, at, _, h = _segments(data, rows, length, gram)
        found.append(h[at])
    if not found:
        return _dealt({}, chunk)
    keys, n = np.unique(np.concatenate(found), return_counts=True)
    n = np.minimum(n, 1 << 15).astype("<u2")
    return _dealt({b: np.array([len(k)], dtype="<i8").tobytes() + keys[k].tobytes() + n[k].tobytes() for b, k in _by_bucket((keys % np.uint64(buckets)).astype(np.int64))}, chunk)


def _read(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(payload, dtype="<i8", count=1)[0])
    return np.frombuffer(payload, dtype="<u8", count=n, offset=8), np.frombuffer(payload, dtype="<u2", count=n, offset=8 + 8 * n)


def repeated_anchors(table: pa.Table) -> pa.Table:
    """Of a bucket's anchors those that occur twice or more, sent back to each chunk that has them, with their number."""
    parts = [_read(p) for p in table.column("payload").to_pylist()]
    keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(k) for k, _ in parts])
    _, which = np.unique(keys, return_inverse=True)
    total = np.bincount(which, weights=n).astype(np.int64)[which]
    again = total >= 2
    order = np.flatnonzero(again)
    chunks = table.column("chunk").to_pylist()
    payloads = [(chunks[b], np.array([len(k)], dtype="<i8").tobytes() + keys[order[k]].tobytes() + np.minimum(total[order[k]], (1 << 16) - 1).astype("<u2").tobytes()) for b, k in _by_bucket(owner[order])] if len(order) else []
    return pa.table({"chunk": [c for c, _ in payloads], "kind": [1] * len(payloads), "payload": [p for _, p in payloads]}, schema=pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())]))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def chunk_segments(chunk: int, left: pa.Table, right: pa.Table, buckets: int, length: int, gram: int, hot: int) -> pa.Table:
    """Segments with repeated anchors and their bytes, dealt out by anchor. A segment that an earlier one of the chunk equals is
    marked here, so a bucket gets at most one of each kind from a chunk. Marks go on in a row of their own."""
    again = [_read(p) for kind, p in zip(right.column("kind").to_pylist(), right.column("payload").to_pylist(), strict=True) if kind == 1]
    keys, total = (np.concatenate([x[k] for x in again]) for k in (0, 1)) if again else (np.empty(0, "<u8"), np.empty(0, "<u2"))
    order = np.argsort(keys)
    keys, total = keys[order], total[order]
    kept, texts, first, marks = [], [], {}, []
    if len(keys):
        steps = list(_steps(left, _copies(right), length))
        for data, rows in steps:
            low, n, at, own, h = _segments(data, rows, length, gram)
            k = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            hit = np.flatnonzero(keys[k] == h[at])
            if not len(hit):
                continue
            low, n, at, own, key, often = low[hit], n[hit], at[hit], own[hit], h[at[hit]], total[k[hit]]
            big = often > hot
            if big.any():  # a window of a hot anchor is a segment of its own
                sizes = np.where(big, n, 1)
                which, step = np.repeat(np.arange(len(n)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                low, n, at, own, key, big = low[which] + step, np.where(big[which], 1, n[which]), at[which], own[which], key[which], big[which]
                key = np.where(big, key ^ (Prefixes(data).every(length)[low] * MIX), key)
            info = np.array([r[:3] for r in rows], dtype=np.int64)[own]
            part = np.empty(len(low), dtype=SEGMENT)
            part["key"], part["oid"], part["tie"], part["low"], part["anchor"], part["n"], part["chunk"] = key, info[:, 0], info[:, 1], low - info[:, 2], at - info[:, 2], n, chunk
            raw, ends = data.tobytes(), (low + n - 1 + length).tolist()
            kept.append(part)
            texts += [raw[a:b] for a, b in zip(low.tolist(), ends, strict=True)]
    out: dict[int, bytes] = {}
    if kept:
        all_ = np.concatenate(kept)
        stay = []
        for k in np.lexsort((all_["low"], all_["tie"], all_["oid"])).tolist():
            row = all_[k]
            name = (int(row["key"]), int(row["anchor"] - row["low"]), texts[k])
            if first.setdefault(name, k) == k:
                stay.append(k)
            else:
                marks.append((row["oid"], row["tie"], row["low"], row["low"] + row["n"] - 1 + length))
        stay = np.array(stay)
        for b, k in _by_bucket((all_["key"][stay] % np.uint64(buckets)).astype(np.int64)):
            chosen = stay[k]
            out[b] = zlib.compress(np.array([len(chosen)], dtype="<i8").tobytes() + all_[chosen].tobytes() + b"".join([texts[j] for j in chosen.tolist()]), 1)
    if marks:
        out[-1 - chunk] = np.array(marks, dtype=SPAN).tobytes()
    return _dealt(out, chunk)


def common_extension(p: Prefixes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common beginning of the suffixes at a and b, up to most: binary search over prefix hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), most, dtype=np.int64)
    for _ in range(int(most).bit_length()):
        mid = (low + high + 1) >> 1
        same = p.hashes(a, mid) == p.hashes(b, mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def _less(data: np.ndarray, p: Prefixes, a: np.ndarray, b: np.ndarray, most: int, or_equal: np.ndarray) -> np.ndarray:
    n = common_extension(p, a, b, most)
    end = n == most
    x, y = data[a + np.where(end, 0, n)], data[b + np.where(end, 0, n)]
    return np.where(end, or_equal, x < y)


def merge_sort(data: np.ndarray, p: Prefixes, at: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes at `at`, by their first `most` bytes inside each group; groups stand together and stay in place.

    Bottom-up: runs double in each round. All items of a round find their place in the sibling run at once, by binary search;
    items of the left run go before equal ones of the right run.
    """
    order = np.arange(len(at))
    if not len(at):
        return order
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(cuts, len(at)))
    begin, size = np.repeat(cuts, sizes), np.repeat(sizes, sizes)
    local, width = np.arange(len(at)) - begin, 1
    while width < sizes.max():
        run = local // width
        left = run % 2 == 0
        other = (run ^ 1) * width
        active = np.flatnonzero((other < size) & (size > width))
        if len(active):
            me, first = at[order[active]], begin[active] + other[active]
            low, high = np.zeros(len(active), dtype=np.int64), np.minimum(width, size[active] - other[active])
            strict = left[active]
            while (open_ := low < high).any():
                mid = (low + high) >> 1
                k = np.flatnonzero(open_)
                # does the sibling's item go before mine? A left item is not passed by equals of the right run
                before = _less(data, p, at[order[first[k] + mid[k]]], me[k], most, ~strict[k])
                low[k], high[k] = np.where(before, mid[k] + 1, low[k]), np.where(before, high[k], mid[k])
            start = np.minimum(run[active], run[active] ^ 1) * width
            to = begin[active] + start + (local[active] - run[active] * width) + low
            moved = order.copy()
            moved[to] = order[active]
            order = moved
        width *= 2
    return order


def equal_classes(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, class of each place in that order): windows of one class are in one group and equal byte for byte.

    Collision verification: neighbours are compared byte for byte. Where they don't stand in order, hashes have collided in some
    comparison; that group is sorted again by its bytes, so that no equal windows stay apart.
    """
    p = Prefixes(data)
    order = merge_sort(data, p, at, group, length)
    s, g = at[order], group[order]
    same = g[1:] == g[:-1]
    k, offsets, wrong = np.flatnonzero(same), np.arange(length), []
    for a in range(0, len(k), 10_000):
        part = k[a : a + 10_000]
        x, y = data[s[part][:, None] + offsets], data[s[part + 1][:, None] + offsets]
        differ = x != y
        at_ = differ.argmax(axis=1)
        same[part] = ~differ[np.arange(len(part)), at_]
        late = x[np.arange(len(part)), at_] > y[np.arange(len(part)), at_]
        wrong += np.unique(g[part[late]]).tolist()
    for group_ in sorted(set(wrong)):
        k = np.flatnonzero(g == group_)
        texts = [data[x : x + length].tobytes() for x in s[k].tolist()]
        by = sorted(range(len(k)), key=texts.__getitem__)
        order[k] = order[k][by]
        same[k[:-1]] = [texts[i] == texts[j] for i, j in zip(by, by[1:], strict=False)]
    return order, np.concatenate(([0], np.cumsum(~same)))


def later_windows(segments: np.ndarray, data: np.ndarray, begin: np.ndarray, length: int) -> np.ndarray:
    """SPANs of the windows that also start earlier. segments of one key stand together; begin is where a segment's bytes start in data."""
    rank = np.empty(len(segments), dtype=np.int64)
    rank[np.lexsort((segments["anchor"], segments["tie"], segments["oid"]))] = np.arange(len(segments))
    n = segments["n"].astype(np.int64)
    own = np.repeat(np.arange(len(segments)), n)
    step = _ranges(np.zeros(len(n), dtype=np.int64), n)
    offset = segments["anchor"][own] - segments["low"][own] - step
    key = np.cumsum(np.concatenate(([0], segments["key"][1:] != segments["key"][:-1])))[own]
    by = np.lexsort((rank[own], offset, key))
    group = np.cumsum(np.concatenate(([0], (key[by][1:] != key[by][:-1]) | (offset[by][1:] != offset[by][:-1]))))
    counts = np.bincount(group)
    by, group = by[counts[group] > 1], group[counts[group] > 1]  # alone at its offset: repeats nowhere
    if not len(by):
        return np.empty(0, dtype=SPAN)
    order, classes = equal_classes(data, (begin[own] + step)[by], group, length)
    item = by[order]
    earliest = np.minimum.reduceat(rank[own[item]], np.flatnonzero(np.diff(classes, prepend=-1)))[classes]
    later = np.sort(item[rank[own[item]] != earliest])
    if not len(later):
        return np.empty(0, dtype=SPAN)
    # neighbouring windows of a segment make one span
    new = np.concatenate(([True], (later[1:] != later[:-1] + 1) | (own[later[1:]] != own[later[:-1]])))
    a, b = later[new], later[np.append(np.flatnonzero(new)[1:], len(later)) - 1]
    out = np.empty(len(a), dtype=SPAN)
    out["oid"], out["tie"] = segments["oid"][own[a]], segments["tie"][own[a]]
    out["start"], out["end"] = segments["low"][own[a]] + step[a], segments["low"][own[b]] + step[b] + length
    return out


def bucket_spans(table: pa.Table, length: int) -> pa.Table:
    """Sorts the suffixes of a bucket, and sends the marked spans to the chunks of their texts."""
    schema = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("payload", pa.binary())])
    if table.column("bucket")[0].as_py() < 0:  # marks made in the chunk
        return pa.table({"chunk": table.column("chunk"), "kind": [2] * table.num_rows, "payload": table.column("payload")}, schema=schema)
    parts, texts = [], []
    for payload in table.column("payload").to_pylist():
        raw = zlib.decompress(payload)
        n = int(np.frombuffer(raw, dtype="<i8", count=1)[0])
        parts.append(np.frombuffer(raw, dtype=SEGMENT, count=n, offset=8))
        texts.append(np.frombuffer(raw, dtype=np.uint8, offset=8 + n * SEGMENT.itemsize))
    segments, data = np.concatenate(parts), np.concatenate(texts)
    sizes = segments["n"].astype(np.int64) - 1 + length
    begin = np.cumsum(sizes) - sizes
    order = np.argsort(segments["key"], kind="stable")
    segments, begin, sizes = segments[order], begin[order], sizes[order]
    edges = np.flatnonzero(np.concatenate(([True], segments["key"][1:] != segments["key"][:-1], [True])))
    ends = np.concatenate(([0], np.cumsum(segments["n"].astype(np.int64))))
    spans, a = [], 0
    while a < len(edges) - 1:  # whole groups, some WINDOWS windows at a time
        b = max(a + 1, int(np.searchsorted(ends[edges], ends[edges[a]] + WINDOWS, side="right")) - 1)
        k = slice(edges[a], edges[b])
        if edges[b] - edges[a] > b - a:  # some group has two segments
            own = sizes[k]
            spans.append((later_windows(segments[k], data[_ranges(begin[k], own)], np.cumsum(own) - own, length), segments["chunk"][k], segments["oid"][k], segments["tie"][k]))
        a = b
    out: dict[int, list[bytes]] = {}
    for found, chunks, oids, ties in spans:
        if len(found):
            of = dict(zip(zip(oids.tolist(), ties.tolist(), strict=True), chunks.tolist(), strict=True))
            where = np.array([of[key] for key in zip(found["oid"].tolist(), found["tie"].tolist(), strict=True)])
            for chunk, k in _by_bucket(where):
                out.setdefault(chunk, []).append(found[k].tobytes())
    return pa.table({"chunk": list(out), "kind": [2] * len(out), "payload": [b"".join(p) for p in out.values()]}, schema=schema)


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: overlapping and touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _cleaned(left: pa.Table, right: pa.Table, length: int, with_text: bool) -> pa.Table:
    copies, spans = _copies(right), {}
    for kind, payload in zip(right.column("kind").to_pylist(), right.column("payload").to_pylist(), strict=True):
        if kind == 2:
            for oid, tie, a, b in np.frombuffer(payload, dtype=SPAN).tolist():
                spans.setdefault((oid, tie), []).append((a, b))
    rows = []
    for doc_id, tie, body in zip(left.column("doc_id").to_pylist(), left.column("tie").to_pylist(), left.column("body").to_pylist(), strict=True):
        key = (LAST if doc_id is None else doc_id, tie)
        gone = [(0, len(body))] if key in copies and len(body) >= length else merged_spans(spans.get(key, []))
        at, kept = 0, []
        for a, b in gone:
            kept.append(body[at:a])
            at = b
        text = b"".join([*kept, body[at:]])
        rows.append((doc_id, len(body), sum(b - a for a, b in gone), len(gone), hashlib.sha256(text).hexdigest(), *([text] if with_text else [])))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), *([("kept", pa.binary())] if with_text else [])]
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(fields)})


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk_bytes: int = CHUNK, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with with_text the bytes kept.

    Earlier means a smaller doc_id, or in one text an earlier start; two texts with one doc_id are ordered by a hash of the text,
    a null doc_id comes last. Rows equal in doc_id and text count as one document and get the same result. Null texts count as
    empty; texts under `length` bytes lose nothing. An empty table gives no rows; other columns are not read. A text that equals
    an earlier one as a whole is settled by its digest and takes no further part, so a large group of copies costs
    one text. Texts are dealt out once, by a hash of doc_id, and read three times from that shuffle.
    """
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    oid = F.coalesce("doc_id", F.lit(LAST))
    sums = materialize(text.select("doc_id", F.xxhash64("text").alias("tie"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.octet_length("text").cast("long").alias("size")))
    total = sums.agg(F.sum("size")).first()[0] or 0
    chunks, partitions = max(1, -(-total // chunk_bytes)), max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    buckets = BUCKETS * partitions
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk")
    # written, so that the join stands between two exchanges and a hot digest can be split
    firsts = materialize(sums.where(F.col("size") >= length).groupBy("digest").agg(F.min(oid).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    pair = F.unhex(F.concat(*[F.concat_ws("", *[F.substring(F.lpad(F.hex(c), 16, "0"), 2 * k + 1, 2) for k in reversed(range(8))]) for c in (oid, F.col("tie"))]))
    copies = sums.join(firsts, "digest").where(oid > F.col("first")).select(chunk, F.lit(0).alias("kind"), pair.alias("payload"))
    base = text.select(chunk, "doc_id", F.xxhash64("text").alias("tie"), F.col("text").cast("binary").alias("body")).repartition(partitions, "chunk")

    def cogrouped(right: DataFrame, f, schema: str) -> DataFrame:
        return base.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(f, schema)

    def key_of(left: pa.Table, right: pa.Table) -> int:
        return (left if left.num_rows else right).column("chunk")[0].as_py()

    found = cogrouped(copies, lambda a, b: chunk_anchors(key_of(a, b), a, b, buckets, length, gram), PACKED)
    again = found.repartition(partitions, "bucket").groupBy("bucket").applyInArrow(repeated_anchors, "chunk long, kind int, payload binary")
    parts = cogrouped(copies.unionByName(again), lambda a, b: chunk_segments(key_of(a, b), a, b, buckets, length, gram, hot), PACKED)
    marks = parts.repartition(partitions, "bucket").groupBy("bucket").applyInArrow(lambda t: bucket_spans(t, length), "chunk long, kind int, payload binary")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return cogrouped(copies.unionByName(marks), lambda a, b: _cleaned(a, b, length, with_text), out)
