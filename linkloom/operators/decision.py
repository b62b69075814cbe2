"""From scored pairs (rid, gid, source, p) to matches, and the searches for the best decision."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evaluation import entity_scores, f_half


@dataclass(frozen=True)
class Decision:
    """A pair is accepted at its source's threshold or at high_conf. Then margin keeps only the top pair if the second
    comes closer than margin, max_matches cuts, and top_only asks for the best pair alone."""

    threshold: float = 0.5
    threshold_s2: float | None = None
    threshold_s3: float | None = None
    high_conf: float = 0.995
    margin: float = 0.0
    top_only: bool = False
    max_matches: int = 0


#: Coarse grid, and the variants that the ambiguity search tries.
COARSE = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.875, 0.90, 0.925, 0.95, 0.975]
MARGINS, MOST = [0.05, 0.10, 0.20, 0.35], [1, 2, 3, 5]
FINE_REACH, FINE_STEP, FINE_LOW, FINE_HIGH = 0.10, 0.005, 0.02, 0.995
GAIN = 1e-6


def accepted(scored: DataFrame, d: Decision) -> DataFrame:
    """Accepted pairs. Ties in p go by id, so the result doesn't depend on partitioning."""
    by_rank = Window.partitionBy("rid").orderBy(F.desc("p"), "gid")
    own = F.when(F.col("source") == "S2", F.lit(d.threshold if d.threshold_s2 is None else d.threshold_s2)).when(F.col("source") == "S3", F.lit(d.threshold if d.threshold_s3 is None else d.threshold_s3)).otherwise(F.lit(d.threshold))
    passes = (F.col("p") >= own) | (F.col("p") >= d.high_conf)
    if d.top_only:
        return scored.withColumn("rn", F.row_number().over(by_rank)).where((F.col("rn") == 1) & passes).drop("rn")
    kept = scored.where(passes)
    if d.margin <= 0 and d.max_matches <= 0:
        return kept
    kept = kept.withColumn("rn", F.row_number().over(by_rank))
    if d.margin > 0:
        whole = Window.partitionBy("rid")
        gap = F.max(F.when(F.col("rn") == 1, F.col("p"))).over(whole) - F.max(F.when(F.col("rn") == 2, F.col("p"))).over(whole)
        kept = kept.withColumn("gap", gap).where((F.col("rn") == 1) | ~(F.coalesce(F.col("gap"), F.lit(1.0)) < d.margin)).drop("gap")
    if d.max_matches > 0:
        kept = kept.where(F.col("rn") <= d.max_matches)
    return kept.drop("rn")


def fine_grid(center: float) -> list[float]:
    return [round(float(v), 4) for v in np.arange(max(FINE_LOW, center - FINE_REACH), min(FINE_HIGH, center + FINE_REACH) + 1e-9, FINE_STEP)]


def production_grid() -> list[float]:
    """Ascending from .50 to .99 by hundredths and on towards .9999: the thresholds that training tries."""
    return sorted({round(float(v), 4) for v in [*np.arange(0.50, 0.9901, 0.01), *np.arange(0.990, 0.9991, 0.001), *np.linspace(0.9990, 0.9999, 10)]})


def threshold_sweep(scored: DataFrame, truth: DataFrame, entities: DataFrame, grid: Sequence[float], high_conf: float = 0.995) -> DataFrame:
    """(threshold, macro_f05) for each value of the grid, over the given entities, in one pass.

    A pair is accepted at all thresholds up to its score, so a pair is a place in the sorted grid. An entity's pairs are counted by
    place; suffix sums over at most len(grid) places give its score at every threshold.
    """
    grid = sorted(grid)
    effective = [min(t, high_conf) for t in grid]
    place = sum((F.when(F.col("p") >= t, 1).otherwise(0) for t in effective), F.lit(0))
    hits = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).distinct().withColumn("hit", F.lit(1))
    counted = scored.join(entities.select(F.col("entity_id").alias("rid")), "rid", "left_semi").join(hits, ["rid", "gid"], "left")
    places = counted.groupBy("rid", place.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("tp"))
    lists = places.groupBy("rid").agg(F.collect_list(F.struct("k", "n", "tp")).alias("places"))
    wanted = hits.groupBy("rid").agg(F.count(F.lit(1)).alias("n_truth"))
    whole = entities.select(F.col("entity_id").alias("rid")).join(lists, "rid", "left").join(wanted, "rid", "left").withColumn("n_truth", F.coalesce("n_truth", F.lit(0)))
    empty = F.array().cast("array<struct<k:int,n:bigint,tp:bigint>>")
    total = lambda g, field: F.aggregate(F.filter(F.coalesce("places", empty), lambda x: x["k"] > g), F.lit(0).cast("long"), lambda a, x: a + x[field])
    each = whole.select("n_truth", F.explode(F.transform(F.sequence(F.lit(0), F.lit(len(grid) - 1)), lambda g: F.struct(g.alias("g"), total(g, "n").alias("n"), total(g, "tp").alias("tp")))).alias("x"))
    score = f_half(F.col("x.tp"), F.col("x.n"), F.col("n_truth"))
    return each.groupBy(F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("x.g") + 1).alias("threshold")).agg(F.avg(score).alias("macro_f05"))


def macro(scored: DataFrame, truth: DataFrame, entities: DataFrame, d: Decision) -> float:
    return entity_scores(accepted(scored, d), truth, entities).agg(F.avg("f05")).first()[0] or 0.0


def best_threshold(scored: DataFrame, truth: DataFrame, entities: DataFrame, coarse: Sequence[float] = COARSE, fine: bool = True) -> tuple[Decision, float]:
    """The first threshold with the best macro score: the coarse grid, then the fine grid around its winner. Two passes; the tables have a row for each grid value."""
    best, score = Decision(), -1.0
    for grid in (coarse, None):
        if grid is None and not fine:
            break
        rows = threshold_sweep(scored, truth, entities, grid or fine_grid(best.threshold)).orderBy("threshold").collect()
        for r in rows:
            if r["macro_f05"] > score:
                best, score = Decision(threshold=r["threshold"]), r["macro_f05"]
    return best, score


def best_source_thresholds(scored: DataFrame, truth: DataFrame, entities: DataFrame, base: Decision, grid: Sequence[float] = COARSE) -> tuple[Decision, float]:
    """Greedy: S2's own threshold, then S3's, each kept if it gains. For a source its pairs are swept and the other's stay fixed,
    which is one pass for each source."""
    best, score = base, macro(scored, truth, entities, base)
    for source, field in (("S2", "threshold_s2"), ("S3", "threshold_s3")):
        fixed = accepted(scored.where(F.col("source") != source), best).withColumn("p", F.lit(2.0))
        rows = threshold_sweep(fixed.unionByName(scored.where(F.col("source") == source)), truth, entities, grid, best.high_conf).orderBy("threshold").collect()
        top, at = score, None
        for r in rows:
            if r["macro_f05"] > top + GAIN:
                top, at = r["macro_f05"], r["threshold"]
        if at is not None:
            best, score = replace(best, **{field: at}), top
    return best, score


def best_ambiguity(scored: DataFrame, truth: DataFrame, entities: DataFrame, base: Decision) -> tuple[Decision, float]:
    """Nine variants on top of base; a variant must gain to be taken."""
    best, score = base, macro(scored, truth, entities, base)
    for d in [replace(base, top_only=True), *[replace(base, margin=m) for m in MARGINS], *[replace(base, max_matches=k) for k in MOST]]:
        own = macro(scored, truth, entities, d)
        if own > score + GAIN:
            best, score = d, own
    return best, score


def consistent(matches: DataFrame, scored: DataFrame, demote_ratio: float = 0.55, min_prob: float = 0.5) -> DataFrame:
    """Drops a marginal match (p < min_prob) of a source whose strongest match is under demote_ratio of the entity's strongest."""
    p = scored.groupBy("rid", "gid").agg(F.max("p").alias("best"))
    each = matches.drop("p").join(p, ["rid", "gid"], "left").withColumn("best", F.coalesce("best", F.lit(0.0)))
    strongest, overall = F.max("best").over(Window.partitionBy("rid", "source")), F.max("best").over(Window.partitionBy("rid"))
    marked = each.withColumn("strongest", strongest).withColumn("overall", overall)
    drop = (F.col("best") < min_prob) & (F.col("strongest") < F.col("overall")) & (F.col("strongest") < demote_ratio * F.col("overall"))
    return marked.where(~drop).select("rid", "gid", "source", F.col("best").alias("p"))


def production_decision(scored: DataFrame, threshold: float, override: float = 0.999) -> DataFrame:
    """Threshold or override; search and prediction share it."""
    return accepted(scored, Decision(threshold=threshold, high_conf=override))


def with_margins(scored: DataFrame) -> DataFrame:
    """Per entity: best and second score, their margin and the number of candidates, for error analysis."""
    order = Window.partitionBy("rid").orderBy(F.desc("p"), "gid")
    return scored.withColumn("rn", F.row_number().over(order)).groupBy("rid").agg(
        F.max(F.when(F.col("rn") == 1, F.col("p"))).alias("top"), F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("p"))), F.lit(0.0)).alias("second"), F.count(F.lit(1)).alias("n_candidates"),
    ).withColumn("margin", F.col("top") - F.col("second"))


def errors(scored: DataFrame, matches: DataFrame, truth: DataFrame) -> DataFrame:
    """(rid, gid, kind, p, top, second, margin, n_candidates) of false positives and false negatives."""
    want = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).distinct()
    got = matches.select("rid", "gid").distinct()
    wrong = got.join(want, ["rid", "gid"], "left_anti").withColumn("kind", F.lit("FP")).unionByName(want.join(got, ["rid", "gid"], "left_anti").withColumn("kind", F.lit("FN")))
    p = scored.groupBy("rid", "gid").agg(F.max("p").alias("p"))
    return wrong.join(p, ["rid", "gid"], "left").join(with_margins(scored), "rid", "left")
