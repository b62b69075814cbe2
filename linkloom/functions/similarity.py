"""Pair similarities that Spark lacks, in Arrow batches.

Jaro and Jaro-Winkler work on UTF-8 bytes, a batch of pairs at a time in NumPy. The ratio family works on characters; its
longest common subsequence is bit-parallel, a batch of pairs at a time. Each batch scores a distinct pair of strings once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Winkler's bonus holds above this Jaro value, for up to PREFIX bytes.
BOOST, PREFIX, WEIGHT = 0.7, 4, 0.1
BLOCK = 2_048


def doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _matrix(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(v) for v in values])
    wide = max(1, int(size.max(initial=0)))
    return np.frombuffer(b"".join(v.ljust(wide, b"\0") for v in values), dtype=np.uint8).reshape(len(values), wide), size


def jaro_batch(left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Jaro and Jaro-Winkler of aligned lists. Two empty strings score 0."""
    a, la = _matrix(left)
    b, lb = _matrix(right)
    n, wide, reach = len(left), b.shape[1], np.maximum(np.maximum(la, lb) // 2 - 1, 0)
    columns = np.arange(wide)
    used_a, used_b = np.zeros(a.shape, dtype=bool), np.zeros(b.shape, dtype=bool)
    inside = columns < lb[:, None]
    rows = np.arange(n)
    for i in range(int(la.max(initial=0))):
        low, high = i - reach, i + reach
        free = (b == a[:, i, None]) & ~used_b & inside & (columns >= low[:, None]) & (columns <= high[:, None])
        first = free.argmax(axis=1)
        hit = free[rows, first] & (i < la)
        used_a[hit, i] = True
        used_b[rows[hit], first[hit]] = True
    common = used_a.sum(axis=1)
    # the k-th matched byte of either side, to count transpositions
    in_a, in_b = np.argsort(~used_a, axis=1, kind="stable"), np.argsort(~used_b, axis=1, kind="stable")
    width = min(a.shape[1], wide)
    swapped = ((a[rows[:, None], in_a[:, :width]] != b[rows[:, None], in_b[:, :width]]) & (np.arange(width) < common[:, None])).sum(axis=1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(common > 0, (common / la + common / lb + (common - swapped) / common) / 3, 0.0)
    k = min(PREFIX, a.shape[1], wide)
    same = (a[:, :k] == b[:, :k]) & (np.arange(k) < np.minimum(la, lb)[:, None])
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return jaro, np.where(jaro > BOOST, jaro + prefix * WEIGHT * (1 - jaro), jaro)


def _distinct(left: pd.Series, right: pd.Series) -> tuple[list[str], list[str], np.ndarray]:
    codes, pairs = pd.factorize(pd.Series(list(zip(left.fillna(""), right.fillna(""), strict=True))))
    return [p[0] for p in pairs], [p[1] for p in pairs], codes


@F.pandas_udf(doubles("jaro", "jaro_winkler"))
def _jaro(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for left, right in batches:
        a, b, codes = _distinct(left, right)
        a, b = [x.encode() for x in a], [x.encode() for x in b]
        order = np.argsort([len(x) + len(y) for x, y in zip(a, b, strict=True)], kind="stable")  # pairs of like length share a matrix
        jaro, winkler = np.zeros(len(a)), np.zeros(len(a))
        for k in range(0, len(a), BLOCK):
            part = order[k : k + BLOCK]
            jaro[part], winkler[part] = jaro_batch([a[i] for i in part], [b[i] for i in part])
        yield pd.DataFrame({"jaro": jaro[codes], "jaro_winkler": winkler[codes]})


def jaro_pair(a: Column, b: Column) -> Column:
    """struct(jaro, jaro_winkler); null counts as empty."""
    return _jaro(a, b)


def jaro_winkler(a: Column, b: Column) -> Column:
    return _jaro(a, b)["jaro_winkler"]


def byte_string(text: Column) -> Column:
    """One character for each UTF-8 byte, so that levenshtein() counts bytes."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - byte distance / characters of the longer string (at least 1)."""
    return 1.0 - F.levenshtein(byte_string(a), byte_string(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one row of the table in the bits of an integer."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & masks.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 2 * common_subsequence(a, b) / total if total else 1.0


def _slid(a: str, b: str) -> float:
    """The best ratio of a and a stretch of b that has a's length, or less at either end of b; a is no longer than b."""
    letters, best, n = set(a), 0.0, len(a)
    for end in range(1, len(b) + n):
        start, stop = max(0, end - n), min(end, len(b))
        if (b[stop - 1] if end <= len(b) else b[start]) in letters:
            best = max(best, ratio(a, b[start:stop]))
    return best


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string and a stretch of the longer one; of equal lengths each slides over the other."""
    if not a or not b:
        return float(a == b)
    if len(a) > len(b):
        a, b = b, a
    if a in b:
        return 1.0
    return _slid(a, b) if len(a) < len(b) else max(_slid(a, b), _slid(b, a))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best of three: common words against either side's common words and rest, and the two sides against each other."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_a, only_b = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not only_a or not only_b):
        return 1.0
    left, right = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    sides = [ratio(left, right)]
    if both:
        sides += [ratio(both, left), ratio(both, right)]
    return max(sides)


def partial_token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    return 1.0 if x & y else partial_ratio(" ".join(sorted(x)), " ".join(sorted(y)))


RATIOS: dict[str, Callable[[str, str], float]] = {"ratio": ratio, "partial_ratio": partial_ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "partial_token_set_ratio": partial_token_set_ratio}

# The same ratios for a batch of pairs. The table's rows are bits of 64-bit words, one word for each pair (and stretch), so one
# NumPy step moves all pairs on by a character. Pairs whose shorter string is longer than a word go through the plain functions.
WORD = 64


def _hits(short: list[str], long: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each character of the longer strings the places of the shorter string that it equals, as bits; and both lengths."""
    size = lambda x: np.array([len(v) for v in x])
    n, m = size(short), size(long)

    def codes(values: list[str], wide: int, filler: int) -> np.ndarray:
        out = np.full((len(values), wide), filler, dtype=np.uint32)
        out[np.arange(wide) < size(values)[:, None]] = np.frombuffer("".join(values).encode("utf-32-le"), dtype=np.uint32)
        return out

    a, b = codes(short, int(n.max()), 0xFFFFFFFE), codes(long, int(m.max()) + 1, 0xFFFFFFFF)
    bits = np.zeros(b.shape, dtype=np.uint64)
    for i in range(a.shape[1]):
        bits |= (b == a[:, i, None]).astype(np.uint64) << np.uint64(i)
    return bits, n, m


def _zeros(row: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Zero bits among the lowest n: the length of the common subsequence."""
    full = np.where(n >= WORD, np.uint64(2**64 - 1), (np.uint64(1) << np.minimum(n, WORD - 1).astype(np.uint64)) - np.uint64(1))
    return np.bitwise_count(~row & full)


def _by_length(pairs: list[tuple[str, str]], plain: Callable[[str, str], float], batch: Callable[[list[str], list[str]], np.ndarray], block: int) -> np.ndarray:
    """batch() over blocks of pairs (shorter first, of like lengths), plain() for those that don't fit a word."""
    out = np.zeros(len(pairs))
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    fits = [k for k, (a, _) in enumerate(pairs) if 0 < len(a) <= WORD]
    for k in set(range(len(pairs))) - set(fits):
        out[k] = plain(*pairs[k])
    fits.sort(key=lambda k: (len(pairs[k][1]), len(pairs[k][0])))
    for at in range(0, len(fits), block):
        part = fits[at : at + block]
        out[part] = batch([pairs[k][0] for k in part], [pairs[k][1] for k in part])
    return out


def ratio_batch(pairs: list[tuple[str, str]]) -> np.ndarray:
    def batch(short: list[str], long: list[str]) -> np.ndarray:
        bits, n, m = _hits(short, long)
        row = np.full(len(short), 2**64 - 1, dtype=np.uint64)
        for j in range(bits.shape[1] - 1):
            hit = row & bits[:, j]
            row = (row + hit) | (row - hit)
        return 2 * _zeros(row, n) / (n + m)

    return _by_length(pairs, ratio, batch, BLOCK)


def _slid_batch(short: list[str], long: list[str]) -> np.ndarray:
    """_slid() of every pair: all stretches at once. Those that _slid() leaves out are never better than one that it looks at."""
    bits, n, m = _hits(short, long)
    ends = np.arange(1, int((n + m).max()))
    start = np.maximum(ends - n[:, None], 0)
    row, rows = np.full(start.shape, 2**64 - 1, dtype=np.uint64), np.arange(len(short))[:, None]
    for t in range(int(n.max())):
        at = start + t
        hit = row & np.where(at < ends, bits[rows, np.minimum(at, m[:, None])], np.uint64(0))
        row = (row + hit) | (row - hit)
    wide = np.minimum(ends, m[:, None]) - start
    return np.where(wide > 0, 2 * _zeros(row, n[:, None]) / np.maximum(n[:, None] + wide, 1), 0.0).max(axis=1)


def partial_ratio_batch(pairs: list[tuple[str, str]]) -> np.ndarray:
    out = np.array([1.0 if a in b or b in a else 0.0 for a, b in pairs])
    rest = [k for k in np.flatnonzero(out == 0).tolist() if pairs[k][0] and pairs[k][1]]
    found = _by_length([pairs[k] for k in rest], partial_ratio, _slid_batch, BLOCK // 8)
    out[[k for k in rest]] = found
    even = [k for k in rest if len(pairs[k][0]) == len(pairs[k][1]) <= WORD]  # the other way round as well
    other = _by_length([pairs[k][::-1] for k in even], partial_ratio, _slid_batch, BLOCK // 8)
    out[even] = np.maximum(out[even], other)
    return out


def token_sort_batch(pairs: list[tuple[str, str]]) -> np.ndarray:
    return ratio_batch([(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) for a, b in pairs])


def token_set_batch(pairs: list[tuple[str, str]]) -> np.ndarray:
    """The common words begin either side, so two of the three ratios are known from lengths; the third takes the table."""
    out, open_ = np.zeros(len(pairs)), []
    for k, (a, b) in enumerate(pairs):
        x, y = set(a.split()), set(b.split())
        if not x or not y:
            continue
        both, only_a, only_b = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
        if both and (not only_a or not only_b):
            out[k] = 1.0
            continue
        left, right, n = f"{both} {only_a}".strip(), f"{both} {only_b}".strip(), len(both)
        out[k] = max(2 * n / (n + len(left)), 2 * n / (n + len(right))) if n else 0.0
        open_.append((k, left, right))
    if open_:
        at = [k for k, _, _ in open_]
        out[at] = np.maximum(out[at], ratio_batch([(x, y) for _, x, y in open_]))
    return out


def partial_token_set_batch(pairs: list[tuple[str, str]]) -> np.ndarray:
    out, open_ = np.zeros(len(pairs)), []
    for k, (a, b) in enumerate(pairs):
        x, y = set(a.split()), set(b.split())
        if x and y:
            out[k] = 1.0 if x & y else 0.0
            if not out[k]:
                open_.append((k, " ".join(sorted(x)), " ".join(sorted(y))))
    if open_:
        out[[k for k, _, _ in open_]] = partial_ratio_batch([(x, y) for _, x, y in open_])
    return out


BATCHES: dict[str, Callable[[list[tuple[str, str]]], np.ndarray]] = {"ratio": ratio_batch, "partial_ratio": partial_ratio_batch, "token_sort_ratio": token_sort_batch, "token_set_ratio": token_set_batch, "partial_token_set_ratio": partial_token_set_batch}


def ratios(a: Column, b: Column, *names: str) -> Column:
    """struct of the named ratios; all 0 if either string is null or empty."""
    wanted = names or tuple(RATIOS)

    @F.pandas_udf(doubles(*wanted))
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for left, right in batches:
            x, y, codes = _distinct(left, right)
            some = np.array([bool(p and q) for p, q in zip(x, y, strict=True)], dtype=bool)
            pairs = [(p, q) for p, q in zip(x, y, strict=True) if p and q]
            values = np.zeros((len(x), len(wanted)))
            if pairs:
                values[some] = np.column_stack([BATCHES[n](pairs) for n in wanted])
            yield pd.DataFrame(values[codes], columns=list(wanted))

    return scored(a, b)
