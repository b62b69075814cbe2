"""Classes that meet in cells against plain counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkloom.operators import overlap, retrieval


def lists(spark, clean=12, noisy=300, kinds=9):
    """Clean and noisy records of few kinds of terms, so that classes are large and counts tie."""
    rng = np.random.default_rng(7)
    kind = [sorted(rng.choice([f"t{k}" for k in range(14)], size=int(rng.integers(1, 6)), replace=False).tolist()) for _ in range(kinds)]
    row = lambda i, n: (f"{n}{i:03d}", "S2" if i % 3 else "S3", kind[int(rng.integers(kinds))])
    schema = "entity_id string, source string, terms array<string>"
    return spark.createDataFrame([row(i, "a") for i in range(clean)], schema), spark.createDataFrame([row(i, "b") for i in rng.permutation(noisy).tolist()], schema)


def plain(s1, pool, cap, least, top):
    left, right = s1.collect(), pool.collect()
    held = {t: sum(t in c.terms for c in right) for s in left for t in s.terms}
    out = set()
    for s in left:
        found = sorted((-sum(t in c.terms and held[t] <= cap for t in s.terms), c.entity_id) for c in right)
        out |= {(s.entity_id, g, -n, k) for k, (n, g) in enumerate([x for x in found if -x[0] >= least][:top])}
    return out


@pytest.mark.parametrize(("cap", "least", "top", "cell"), [(10_000, 1, 20, 16_384), (10_000, 2, 7, 3), (140, 1, 200, 2), (10_000, 1, 1, 1)])
def test_gram_overlap_equals_plain_counts(spark, monkeypatch, cap, least, top, cell):
    s1, pool = lists(spark)
    monkeypatch.setattr(overlap, "CELL", cell)
    left, right = overlap.classes(s1, ["terms"], "l"), overlap.classes(pool, ["terms"], "r")
    pairs = overlap.shared_terms(left.select("l", "terms"), right.select("r", "n", "terms"), cap, least, top)
    clean = s1.join(left, "terms").select("l", F.col("entity_id").alias("rid"))
    members = pool.join(right, "terms").select("r", F.col("entity_id").alias("gid"), "source")
    got = overlap.expanded(pairs, F.col("shared"), clean, members, ["l"], ["r"], top)
    assert {(r.rid, r.gid, r.shared, r["rank"]) for r in got.collect()} == plain(s1, pool, cap, least, top)


def test_copies_are_met_once(spark):
    """600 copies of six names against 50 copies of three are 18 pairs of classes."""
    s1 = spark.range(50).select(F.concat(F.lit("a"), "id").alias("entity_id"), F.array(F.lit("x"), F.concat(F.lit("y"), F.col("id") % 3)).alias("g"))
    pool = spark.range(600).select(F.concat(F.lit("b"), "id").alias("entity_id"), F.lit("S2").alias("source"), F.array(F.lit("x"), F.concat(F.lit("y"), F.col("id") % 6)).alias("g"))
    left, right, pairs = retrieval._by_terms(s1, pool, ["g"], ["g"], F.col("g"), F.col("g"), 10_000, 1, None)
    assert (left.count(), right.count(), pairs.count()) == (3, 6, 18)
    assert retrieval.gram_overlap(s1, pool, "g", 100).count() == 50 * 100


def test_scores_are_made_once_for_equal_names(spark):
    pairs = spark.range(1000).select("id", (F.col("id") % 2).alias("a"), (F.col("id") % 5).alias("b"))
    scored = overlap.once(pairs, ["a", "b"], s=F.col("a") * 10 + F.col("b"))
    assert scored.count() == 1000 and scored.where("s <> a * 10 + b").count() == 0


def test_only_wanted_blocks_are_made(spark, monkeypatch):
    """Classes are counted when a block is made, so a block that nobody asked for must not be."""
    made = lambda *a, **b: pytest.fail("not wanted")
    for name in ("postal_name", "country_approx", "token_overlap", "gram_overlap"):
        monkeypatch.setattr(retrieval, name, made)
    s1 = spark.createDataFrame([("a", "x y", "x y", "x y", "", "", ["x", "y"], ["x", "y"], [], "fr")], "entity_id string, name string, name_heavy string, name_core string, addr string, house string, name_tokens array<string>, core_tokens array<string>, addr_tokens array<string>, country string")
    merged, _ = retrieval.merged_blocks(s1, s1.withColumn("entity_id", F.lit("b")).withColumn("source", F.lit("S2")), ["exact_name"])
    assert [(r.rid, r.gid, r.blocks) for r in merged.collect()] == [("a", "b", 1)]
