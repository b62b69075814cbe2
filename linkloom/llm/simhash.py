"""SimHash near-duplicates: fingerprints, a segment-popcount embedding, a grid range join, exact verification.

The embedding maps a fingerprint to its counts of set bits in 32 segments of two bits. Flipping a bit changes one count by
one, so the Manhattan distance of two count vectors is at most the Hamming distance of the fingerprints. Counts are
kept in unary inside their two bits, which makes that distance a population count. For the range join the segments
form blocks; vectors within distance r differ in at most r blocks, so each choice of all blocks but r is a grid, and a
pair in range shares a cell of at least one. Inside the join the Manhattan bound is tested, then the exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, materialize, small

SHINGLE, RADIUS, SEED = 3, 2, 42
EVEN = 0x5555555555555555


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer: a bit is set if it is in over half of the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: only A-Z change, and only the six ASCII spaces part words
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, stops = np.concatenate(([0], ends[: n - 1])).tolist(), (ends[len(words) - n :] - 1).tolist()
    total = np.zeros(64, dtype=np.int64)
    for k in range(0, n, 65536):
        part = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[k : k + 65536], stops[k : k + 65536], strict=True)), dtype=">u8", count=min(65536, n - k))
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed bigint) of every row; null texts count as empty and get 0."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select("doc_id", hashed(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedding(fp):
    """32 counts of 0 to 2, each in unary in two bits."""
    low, high = fp.bitwiseAND(F.lit(EVEN)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(EVEN))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))


def grids(blocks: int, radius: int) -> list[int]:
    """A mask for each choice of blocks - radius blocks of the 32 segments."""
    cuts = [round(k * 32 / blocks) for k in range(blocks + 1)]
    parts = [((1 << 2 * b) - 1) ^ ((1 << 2 * a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [_signed(sum(kept)) for kept in combinations(parts, blocks - radius)]


def blocks_for(n: int, radius: int) -> int:
    """The fewest blocks whose cells hold enough bits (1.5 for each segment) for n fingerprints; any number is exact."""
    return next((m for m in (radius + 2, radius + 3, radius + 4, radius + 6, radius + 8) if 1.5 * 32 * (m - radius) / m >= np.log2(max(n, 2)) + 8), radius + 8)


def fingerprint_links(heads: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of head ids whose fingerprints (fp, distinct) differ in at most radius bits.

    A fingerprint has at most 64 + 2016 others within two bits, so the links stay linear in the rows however the
    texts are grouped. Skewed cells are plain join keys, which adaptive execution splits.
    """
    masks = grids(blocks_for(heads.count(), radius), radius)
    e = heads.select("fp", "head", embedding(F.col("fp")).alias("e"))
    cells = e.select("fp", "head", "e", F.explode(F.array(*[F.struct(F.lit(i).alias("grid"), F.col("e").bitwiseAND(F.lit(m)).alias("cell")) for i, m in enumerate(masks)])).alias("g")).select("fp", "head", "e", "g.grid", "g.cell")
    a, b = cells.alias("a"), cells.alias("b")
    near = (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(F.col("a.e").bitwiseXOR(F.col("b.e"))) <= radius) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= radius)
    same = (F.col("a.grid") == F.col("b.grid")) & (F.col("a.cell") == F.col("b.cell"))
    return a.join(b, same & near).select(F.col("a.head").alias("a"), F.col("b.head").alias("b")).distinct()


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, class_size.

    Equal fingerprints are one class, represented by their smallest doc_id; classes are linked, and component_id is the
    smallest doc_id reachable. Texts without words have the fingerprint 0 and link like any other. Repeated rows come out as
    often as they come in; rows with a null doc_id take part but lend no id; an empty table gives no rows; other columns are
    not read.
    """
    fps = materialize(fingerprints(docs, shingle))
    heads = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("class_size")))
    found = connected_components(fingerprint_links(heads.where("head is not null"), radius))
    classes = heads.join(found.withColumnRenamed("node", "head"), "head", "left").select("fp", F.coalesce("component", "head").alias("component_id"), "class_size")
    return fps.join(classes, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_size")


# Near-duplicates by shingle similarity. The dealt method proposes first: texts whose fingerprints are equal or lie in range
# of the grid join. A similarity of 0.8 leaves two 64-bit fingerprints some ten bits apart, where no grid is selective, so
# more cells come from samples: a band is the fingerprint of the SAMPLE smallest hashes of a text's shingles
# under a permutation, and two texts share it with probability similarity ** SAMPLE. A cell's members first meet one pivot.
# Members whose components then still differ meet through the rarest of their shingles, by exact prefix, length and positional
# filters. Pairs are bounded by parity words, which cut no linked pair; two long texts also by the wide
# fingerprint, first by segment counts, then by bits. What remains is verified on the shingle sets.
NEAR_SHINGLE, SIMILARITY = 5, 0.8
BANDS, SAMPLE = 10, 3
#: Words of the wide fingerprint, 64 bits each.
WIDE = 4
#: Words of parity: each shingle flips one of their bits, so they differ in no more bits than the sets differ in shingles.
PARITY = 16
#: The fingerprint bounds only pairs of texts of LONG shingles or more, where its bits keep to the expected distance; DEVIATIONS
#: is how far a linked pair may lie above it.
LONG, DEVIATIONS = 1_000, 6.0
SKETCH = "fp array<long>, bands array<long>, shingles long, parity array<long>"
_ODD = np.random.default_rng(SEED).integers(1 << 32, 1 << 63, size=(BANDS + WIDE, 2), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: bytes, shingle: int = NEAR_SHINGLE) -> np.ndarray:
    """Distinct XXH64 of the word shingles, sorted; a text of fewer words is one shingle, one without words has none."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, stops = np.concatenate(([0], ends[: n - 1])).tolist(), (ends[len(words) - n :] - 1).tolist()
    return np.unique(np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), dtype=np.uint64, count=n))


def _permuted(h: np.ndarray, k: int) -> np.ndarray:
    x = (h ^ _ODD[k, 0]) * _ODD[k, 1]
    return x ^ (x >> np.uint64(31))


def sketch(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The wide fingerprint of a shingle set, and its bands; a set without shingles has no bands."""
    fp = np.zeros(WIDE, dtype=np.uint64)
    for k in range(WIDE):
        total = np.zeros(64, dtype=np.int64)
        for a in range(0, len(h), 65536):
            part = (_permuted(h[a : a + 65536], BANDS + k)).astype(">u8")
            total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        fp[k] = int.from_bytes(np.packbits(2 * total > len(h)).tobytes(), "big")
    bands = np.empty(BANDS if len(h) else 0, dtype=np.uint64)
    for k in range(len(bands)):
        x = _permuted(h, k)
        least = np.sort(np.partition(x, SAMPLE - 1)[:SAMPLE] if len(x) > SAMPLE else x)
        mixed = np.uint64(k + 1)
        for v in least:
            mixed = (mixed ^ v) * _ODD[0, 1]
            mixed ^= mixed >> np.uint64(29)
        bands[k] = mixed
    return fp.view(np.int64), bands.view(np.int64)


def parity(h: np.ndarray) -> np.ndarray:
    """The parity words of a shingle set: a bit is set if an odd number of shingles falls on it."""
    odd = np.bincount((h % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def most_bits(similarity: float, deviations: float = DEVIATIONS) -> int:
    """Differing bits of the wide fingerprint that a pair of this similarity stays under: the expected number and some deviations."""
    cosine = 2 * similarity / (1 + similarity)
    p, n = np.arccos(cosine) / np.pi, 64 * WIDE
    return int(np.ceil(n * p + deviations * np.sqrt(n * p * (1 - p))))


def _bytes_of_text():
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, bands, shingles, parity) of the rows that have an id."""

    @F.pandas_udf(SKETCH)
    def sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for texts in batches:
                sets = [shingle_set(t) for t in texts]
                rows = [sketch(h) for h in sets]
                yield pd.DataFrame({"fp": [r[0] for r in rows], "bands": [r[1] for r in rows], "shingles": [len(h) for h in sets], "parity": [parity(h) for h in sets]})

    return docs.where("doc_id is not null").select("doc_id", sketched(_bytes_of_text()).alias("s")).select("doc_id", "s.*")


def _apart(a: str, b: str, column: str, words: int):
    return sum((F.bit_count(F.col(f"{a}.{column}")[k].bitwiseXOR(F.col(f"{b}.{column}")[k])) for k in range(1, words)), F.bit_count(F.col(f"{a}.{column}")[0].bitwiseXOR(F.col(f"{b}.{column}")[0])))


def _within(a: str, b: str, similarity: float):
    """What every pair of the similarity meets, however it was proposed.

    Such sets differ in at most (1 - similarity) / (1 + similarity) of their shingles taken together; so do their sizes and their
    parity words, exactly. Two long texts are also held to the Manhattan bound on the segment counts of the first fingerprint word,
    then to the Hamming distance of all.
    """
    x, y, bits = F.col(f"{a}.shingles"), F.col(f"{b}.shingles"), most_bits(similarity)
    most = (x + y) * F.lit((1 - similarity) / (1 + similarity)) + F.lit(1e-6)
    low = F.bit_count(embedding(F.col(f"{a}.fp")[0]).bitwiseXOR(embedding(F.col(f"{b}.fp")[0]))) <= bits
    return (F.abs(x - y) <= most) & (_apart(a, b, "parity", PARITY) <= most) & ((F.least(x, y) < LONG) | (low & (_apart(a, b, "fp", WIDE) <= bits)))


def bounded(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Of pairs (a, b) those that _within() can't exclude."""
    x, y = rows.select(F.col("doc_id").alias("a"), "fp", "shingles", "parity").alias("x"), rows.select(F.col("doc_id").alias("b"), "fp", "shingles", "parity").alias("y")
    return pairs.join(x, "a").join(y, "b").where(_within("x", "y", similarity)).select("a", "b").distinct()


def shingle_arrays(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, set) of the documents in ids (materialized, distinct): the sorted hashes of shingle_set(). Texts are shuffled only where the ids are too many to broadcast."""

    @F.pandas_udf("array<long>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_set(t).view(np.int64) for t in texts], dtype=object)

    return docs.select("doc_id", _bytes_of_text().alias("text")).join(small(ids, ids.count()), "doc_id", "left_semi").select("doc_id", hashed("text").alias("set"))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of materialized pairs (a, b) those whose shingle sets reach the similarity."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = sets.join(small(ids, 2 * pairs.count()), "doc_id", "left_semi")  # few of the sets are in a pair
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= (F.size("x") + F.size("y") - common) * F.lit(similarity) - F.lit(1e-9)).select("a", "b").distinct()


def _pair(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def grid_pairs(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs that the dealt method proposes: texts of one fingerprint (its first word) with the smallest id among them, and those ids in range of each other."""
    own = rows.where("shingles > 0").select("doc_id", F.col("fp")[0].alias("fp"))
    heads = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("head")))
    same = own.join(heads, "fp").where("doc_id <> head").select(*_pair(F.col("head"), F.col("doc_id")))
    return same.union(fingerprint_links(heads, radius).select(*_pair(F.col("a"), F.col("b"))))


def shared_cells(rows: DataFrame) -> DataFrame:
    """(band, cell, doc_id, weight, pivot) for cells with two documents or more.

    weight adds the members of all cells of the document. A copy with few edits shares more cells than one with many, so the
    heaviest member of a cell, its pivot, lies near the middle of a group. Counts and pivots combine before the shuffle.
    """
    each = rows.select("doc_id", F.posexplode("bands").alias("band", "cell")).distinct()
    counts = each.groupBy("band", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cells = materialize(each.join(counts, ["band", "cell"]))
    weights = cells.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    weighed = cells.join(weights, "doc_id").select("band", "cell", "doc_id", "weight")
    pivots = weighed.groupBy("band", "cell").agg(F.max_by("doc_id", F.struct("weight", -F.col("doc_id"))).alias("pivot"))
    out = materialize(weighed.join(pivots, ["band", "cell"]))
    discard(cells)
    return out


def prefix_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """Candidate pairs (a, b) among members (doc_id, component, set) of different components: an exact set-similarity join.

    Shingles are ordered by the number of members that hold them, rarest first. Two sets that reach the similarity share one
    of their first n - ceil(similarity * n) + 1 shingles in that order, their sizes agree to the similarity, and from the
    first shared one on both have enough shingles left. Shingles held once take places of a prefix and lead to no
    pair. Under each shingle the members of the commonest component meet only members of others, so a
    group that is settled already is not expanded into its pairs.
    """
    tokens = members.select("doc_id", "component", F.size("set").alias("n"), F.explode("set").alias("token"))
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    ordered = tokens.join(held, "token").groupBy("doc_id", "component", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    length = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(1e-9)) + 1
    prefix = ordered.select("doc_id", "component", "n", alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), F.greatest(length - alone, F.lit(0)).cast("int"))).alias("k", "s"))
    prefix = materialize(prefix.select("doc_id", "component", "n", (F.col("alone") + F.col("k") + 1).alias("place"), F.col("s.token").alias("token")))
    sizes = prefix.groupBy("token", "component").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("token").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("components")).where("components > 1").select("token", "main")
    open_ = prefix.join(main, "token")
    x, y = open_.where("component <> main").alias("x"), open_.alias("y")
    need = F.ceil((F.col("x.n") + F.col("y.n")) * F.lit(similarity / (1 + similarity)) - F.lit(1e-9))
    left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.doc_id") < F.col("y.doc_id"))
    sized = F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(similarity) - F.lit(1e-9)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") != F.col("y.component")) & once & sized & (left >= need))
    found = materialize(pairs.select(*_pair(F.col("x.doc_id"), F.col("y.doc_id"))).distinct())
    discard(prefix)
    return found


def near_duplicate_components(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id) of the documents that have a near-duplicate.

    Links join documents whose sets of five-word shingles have a Jaccard similarity of `similarity` or more; component_id is the
    smallest doc_id reachable. The grid join on fingerprints proposes pairs; each band cell adds those of its members with the
    cell's pivot, as many as it has members. Of cells whose other members then lie in more than one component all those
    members go through prefix_pairs(), which misses no pair among them; so every pair that shares a cell is either joined
    by way of others or compared, in cells of any size. A pair of
    similarity exactly 0.8 shares a band with probability 0.999 (less for texts of a few shingles: 0.994 at 4 of 5); the sizes
    and parity words never cut it, and the fingerprints of two long texts lie DEVIATIONS above the expected distance with less than
    1e-6. Rows that share a doc_id count as one document; null ids and texts without words link to nothing; an empty table
    gives no rows.
    """
    rows = materialize(sketches(docs))
    cells = shared_cells(rows)
    star = cells.where("doc_id <> pivot").select(*_pair(F.col("pivot"), F.col("doc_id")))
    pairs = materialize(bounded(star.union(grid_pairs(rows)).distinct(), rows, similarity))
    ids = materialize(cells.select("doc_id").union(pairs.select("a")).union(pairs.select("b")).distinct())
    sets = materialize(shingle_arrays(docs, ids))
    links = materialize(verified(pairs, sets, similarity))
    first = connected_components(links).withColumnRenamed("node", "doc_id")
    others = materialize(cells.where("doc_id <> pivot").select("band", "cell", "doc_id").join(first, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id")))
    open_ = others.groupBy("band", "cell").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("band", "cell")
    members = materialize(others.join(open_, ["band", "cell"], "left_semi").select("doc_id", "component").distinct().join(sets, "doc_id"))
    proposed = prefix_pairs(members, similarity)
    likely = materialize(bounded(proposed, rows, similarity))
    more = materialize(verified(likely, sets, similarity))
    found = connected_components(first.select(F.col("doc_id").alias("a"), F.col("component").alias("b")).union(more))
    discard(rows, cells, pairs, ids, sets, links, others, members, proposed, likely, more)
    return found.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with its own columns, and of each near-duplicate component only the document with the smallest doc_id.

    Rows that share that doc_id all stay, as do rows without a doc_id and texts without words; an empty table gives no rows.
    """
    found = near_duplicate_components(docs, similarity).where("component_id <> doc_id").select(F.col("doc_id").alias("gone"))
    gone = materialize(found)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return packed.join(small(gone, gone.count()), F.col("row.doc_id") == F.col("gone"), "left_anti").select("row.*")
