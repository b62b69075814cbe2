"""Candidate generation: blocking keys, caps on a key's candidates, one join, merge, rank and cap."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler


@dataclass(frozen=True)
class Block:
    """Records meet if all key columns are equal and not empty. A key with more than cap candidates is dropped. With
    least > 0 a pair must also reach that Jaro-Winkler similarity in column `on`, unless the clean record's is empty."""

    name: str
    bit: int
    keys: tuple[str, ...]
    cap: int = 200
    least: float = 0.0
    on: str = "name"


BLOCKS = (
    Block("exact_name", 1, ("country", "name")),
    Block("exact_name_heavy", 2, ("country", "name_heavy")),
    Block("core_name", 4, ("country", "name_core")),
    Block("exact_address", 8, ("addr",)),
    Block("name_house", 16, ("country", "name", "house"), cap=100),
    Block("postal_name", 32, ("country", "postal"), least=0.5),
)
#: Optional: records whose prefixes agree and that are alike. The thresholds are ours.
PREFIX_BLOCKS = (
    Block("name_prefix_fuzzy", 64, ("country", "name_prefix"), least=0.85, on="name_core"),
    Block("address_prefix_fuzzy", 128, ("country", "addr_prefix"), least=0.85, on="addr"),
)
MAX_CANDIDATES = 300


def keyed(records: DataFrame, blocks: Sequence[Block], keep: Sequence[str]) -> DataFrame:
    """One row for each record and block with a key. The separator can't occur in normalised text."""
    key = lambda b: F.when(F.least(*[F.length(c) for c in b.keys], F.lit(1 << 30)) > 0, F.concat_ws("\u0001", *b.keys))
    rows = F.filter(F.array(*[F.struct(F.lit(b.bit).alias("bit"), key(b).alias("key"), F.col(b.on).alias("text")) for b in blocks]), lambda x: x["key"].isNotNull())
    return records.select(*keep, F.explode(rows).alias("k")).select(*keep, "k.bit", "k.key", "k.text")


def _cap(blocks: Sequence[Block]) -> Column:
    return F.coalesce(*[F.when(F.col("bit") == b.bit, F.lit(b.cap)) for b in blocks])


def key_counts(candidates: DataFrame, blocks: Sequence[Block] = BLOCKS) -> DataFrame:
    """(bit, key, n, kept): candidates of every key, and whether the key stays under its cap."""
    counts = keyed(candidates, blocks, []).groupBy("bit", "key").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("kept", F.col("n") <= _cap(blocks))


def block_pairs(s1: DataFrame, candidates: DataFrame, blocks: Sequence[Block] = BLOCKS) -> DataFrame:
    """(rid, gid, source, bit): every pair that a block finds, once for each block.

    All blocks share one equi-join on (bit, key): counts, candidates and clean records are hashed alike, so each is shuffled
    once. Only keys under their cap join, which bounds what a key can produce.
    """
    right = keyed(candidates, blocks, ["entity_id", "source"])
    small = right.groupBy("bit", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= _cap(blocks)).select("bit", "key")
    left = keyed(s1, blocks, ["entity_id"]).select(F.col("entity_id").alias("rid"), "bit", "key", F.col("text").alias("mine"))
    pairs = left.join(right.join(small, ["bit", "key"]), ["bit", "key"]).select("rid", F.col("entity_id").alias("gid"), "source", "bit", "mine", "text")
    fuzzy = [b for b in blocks if b.least > 0]
    if fuzzy:
        tested = F.col("bit").isin([b.bit for b in fuzzy]) & (F.col("mine") != "")
        least = F.coalesce(*[F.when(F.col("bit") == b.bit, F.lit(b.least)) for b in fuzzy])
        # pairs of exact blocks pass nulls, which a batch scores once
        alike = pairs.withColumn("jw", jaro_winkler(F.when(tested, F.col("mine")), F.when(tested, F.col("text"))))
        pairs = alike.where(~tested | (F.col("jw") >= least))
    return pairs.select("rid", "gid", "source", "bit")


def merge(pairs: DataFrame) -> DataFrame:
    """(rid, gid, source, block_mask, block_count). Dealt out by rid alone, so ranking needs no further shuffle."""
    return pairs.repartition("rid").groupBy("rid", "gid", "source").agg(F.expr("bit_or(bit)").alias("block_mask"), F.count(F.lit(1)).alias("block_count"))


def rank_order(blocks: Sequence[Block] = BLOCKS) -> list[Column]:
    """Pairs of stronger blocks first, then more blocks, the larger mask, source and id: a total order."""
    has = [F.col("block_mask").bitwiseAND(F.lit(b.bit)).cast("boolean").cast("int").desc() for b in blocks]
    return [*has, F.desc("block_count"), F.desc("block_mask"), F.asc("source"), F.asc("gid")]


def ranked(merged: DataFrame, blocks: Sequence[Block] = BLOCKS) -> DataFrame:
    return merged.withColumn("rn", F.row_number().over(Window.partitionBy("rid").orderBy(*rank_order(blocks))))


def candidates(s1: DataFrame, pool: DataFrame, blocks: Sequence[Block] = BLOCKS, cap: int = MAX_CANDIDATES) -> DataFrame:
    """(rid, gid, source, block_mask, block_count): at most cap pairs for each clean record, a feature of the method."""
    return ranked(merge(block_pairs(s1, pool, blocks)), blocks).where(F.col("rn") <= cap).drop("rn")


def capped_by_blocks(pairs: DataFrame, cap: int, weight: str = "idf_overlap", count: str = "n_blocks") -> DataFrame:
    """The other cap: most blocks first, then the heavier overlap, then the id."""
    order = Window.partitionBy("rid").orderBy(F.desc(count), F.desc(weight), "gid")
    return pairs.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= cap).drop("rn")
