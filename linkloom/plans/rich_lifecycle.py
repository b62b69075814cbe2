"""Training and prediction of the richer engine: twelve blocks, 79 features, mining, calibration, three searches, consistency."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rich_text
from ..operators import decision, evaluation, model, retrieval, rich_features, sampling
from ..sources.tsv import id_lists
from .lifecycle import ROUNDS, stopping_rows

KEYS = ["rid", "gid", "source"]


@dataclass
class RichTrained:
    model: PipelineModel
    features: list[str]
    calibrator: str
    fitted: object
    decision: decision.Decision
    consistent: bool
    macro_f05: float


def featured(s1: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(prepared clean records, features of all candidates, what is kept). Twelve blocks read the prepared records, the features read the candidates: all three are kept, spilling to disk, until the caller releases them."""
    left, right = rich_text.prepare(s1).persist(), rich_text.prepare(pool).persist()
    found = retrieval.rich_candidates(left, right).persist()
    return left, rich_features.rich_features(found, left, right), [found, left, right]


def release(kept: list[DataFrame]) -> None:
    for x in kept:
        x.unpersist()


def with_tier(rows: DataFrame) -> DataFrame:
    c = F.col
    return rows.withColumn("tier", sampling.difficulty(c("name_ratio"), c("name_token_set_ratio"), c("name_core_exact"), c("addr_ratio"), c("postal_match"), c("house_number_match"), c("token_overlap")))


def scored_by(trained: RichTrained, features: DataFrame) -> DataFrame:
    return model.calibrate(trained.calibrator, trained.fitted, model.score(trained.model, features))


def train_rich(s1: DataFrame, pool: DataFrame, truth: DataFrame, iterations: int = ROUNDS, searches: bool = True) -> RichTrained:
    """Entities are split three ways: trees learn on the first part, the calibrator on the second, and the searches and the score use the third.
    Without searches the decision is a threshold of 0.5, for a quick look."""
    left, all_features, kept = featured(s1, pool)
    columns = [c for c in all_features.columns if c not in KEYS]
    rows = sampling.labelled(all_features, truth).persist()
    part = F.when(sampling.key("rid") % 10 < 6, 0).when(sampling.key("rid") % 10 < 8, 1).otherwise(2)
    entities = left.select("entity_id", F.col("entity_id").alias("rid")).withColumn("part", part)
    of = lambda k: rows.where(part == k)
    ids = lambda k: entities.where(F.col("part") == k).select("entity_id")
    try:
        trees = model.train(stopping_rows(sampling.mine(with_tier(of(0)))), columns, iterations, validation="stopping")
        second = sampling.labelled(model.score(trees, of(1)), truth).persist()
        kind, fitted, _ = model.best_calibrator(second, truth.join(ids(1).withColumnRenamed("entity_id", "s1_id"), "s1_id", "left_semi"), ids(1))
        second.unpersist()
        third = model.calibrate(kind, fitted, model.score(trees, of(2))).persist()
        want, held = truth.join(ids(2).withColumnRenamed("entity_id", "s1_id"), "s1_id", "left_semi"), ids(2)
        best = decision.Decision(threshold=0.5)
        score = decision.macro(third, want, held, best)
        if searches:
            best, _ = decision.best_threshold(third, want, held)
            best, _ = decision.best_source_thresholds(third, want, held, best)
            best, score = decision.best_ambiguity(third, want, held, best)
        checked = decision.consistent(decision.accepted(third, best), third)
        other = evaluation.entity_scores(checked, want, held).agg(F.avg("f05")).first()[0] or 0.0
        third.unpersist()
    finally:
        release([rows, *kept])
    return RichTrained(trees, columns, kind, fitted, best, other > score + decision.GAIN, max(score, other))


def predict_rich(s1: DataFrame, pool: DataFrame, trained: RichTrained) -> DataFrame:
    left, features, _ = featured(s1, pool)  # the result is lazy and reads what is kept
    scored = scored_by(trained, features)
    matches = decision.accepted(scored, trained.decision)
    return id_lists(left, decision.consistent(matches, scored) if trained.consistent else matches, "matched_entity_ids")
