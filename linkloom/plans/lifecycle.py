"""Training and prediction: operators in order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import blocking, decision, evaluation, features, model, sampling
from ..sources.tsv import id_lists


@dataclass
class Trained:
    model: PipelineModel
    decision: decision.Decision
    macro_f05: float
    recall: DataFrame


def prepared_candidates(s1: DataFrame, pool: DataFrame, cap: int = blocking.MAX_CANDIDATES) -> tuple[DataFrame, DataFrame, DataFrame]:
    left, right = text.prepare(s1), text.prepare(pool)
    return left, right, blocking.candidates(left, right, cap=cap)


#: Boosting rounds at most; they end earlier once the stopping entities gain no more.
ROUNDS = 100


def stopping_rows(rows: DataFrame, share: int = 10) -> DataFrame:
    """Marks (column stopping) a tenth of the training entities, by hash: trees don't learn on them, and rounds end when they gain nothing there."""
    return rows.withColumn("stopping", sampling.key("rid", seed=sampling.SEED + 2) % share == 0)


def train(s1: DataFrame, pool: DataFrame, truth: DataFrame, iterations: int = ROUNDS, prepared: tuple[DataFrame, DataFrame, DataFrame] | None = None, featured: DataFrame | None = None) -> Trained:
    """Blocks, injects what blocking missed into the training entities only, trains with early stopping, and chooses the threshold on the held-out entities.

    Recall is measured before injection, scores only on held-out entities. prepared: prepared_candidates() of the lists, if the
    caller has stored it. Here it is stored while it is read three times. featured: features of its pairs, if the caller reads them as well.
    """
    given = prepared is not None
    left, right, found = prepared if given else (x.persist() for x in prepared_candidates(s1, pool))
    try:
        return _train(left, right, found, truth, iterations, featured)
    finally:
        if not given:
            for x in (found, left, right):
                x.unpersist()


def _train(left: DataFrame, right: DataFrame, found: DataFrame, truth: DataFrame, iterations: int, featured: DataFrame | None) -> Trained:
    split = sampling.split_entities(left.select("entity_id"))
    train_ids, held_ids = split.where("split = 'train'").select("entity_id"), split.where("split = 'validation'").select("entity_id")
    own = truth.join(train_ids.withColumnRenamed("entity_id", "s1_id"), "s1_id", "left_semi")
    featured = features.pair_features(found, left, right) if featured is None else featured
    ids = lambda df: df.withColumnRenamed("entity_id", "rid")
    missed = features.pair_features(sampling.missed_positives(found.join(ids(train_ids), "rid", "left_semi"), own, right), left, right)
    rows = sampling.sample_negatives(sampling.labelled(featured.join(ids(train_ids), "rid", "left_semi").unionByName(missed), own)).persist()
    try:  # counted, cut and read by every tree
        fitted = model.train(stopping_rows(sampling.global_cap(rows)), features.FEATURES, iterations, validation="stopping")
    finally:
        rows.unpersist()
    scored = model.score(fitted, featured.join(ids(held_ids), "rid", "left_semi")).persist()
    try:
        best, score = decision.best_threshold(scored, truth, held_ids, decision.production_grid(), fine=False)
    finally:
        scored.unpersist()
    recall = evaluation.candidate_recall(found, truth, left, right)
    one = recall.first()
    return Trained(fitted, best, score, recall.sparkSession.createDataFrame([tuple(one)], recall.schema))


def predict(s1: DataFrame, pool: DataFrame, trained: Trained) -> tuple[DataFrame, DataFrame]:
    """(matching, candidate lists), a row for each clean record in both."""
    left, right, found = prepared_candidates(s1, pool)
    scored = model.score(trained.model, features.pair_features(found, left, right))
    matches = decision.production_decision(scored, trained.decision.threshold)
    return id_lists(s1, matches, "matched_entity_ids"), id_lists(s1, found.select("rid", F.col("gid")), "candidate_entity_ids")


def rule_scores(s1: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates scored by the rule instead of a model."""
    return rule_scores_prepared(s1, text.prepare(pool))


def rule_scores_prepared(s1: DataFrame, right: DataFrame) -> DataFrame:
    """rule_scores() against a pool whose views are there already."""
    left = text.prepare(s1)
    return features.rule_score(features.pair_features(blocking.candidates(left, right), left, right))
