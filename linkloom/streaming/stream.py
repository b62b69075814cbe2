"""Clean records that arrive as a stream, matched against prepared candidates.

Each record is independent of the others, so there is no state and no late data: a micro-batch goes through the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..functions import text
from ..operators import decision
from ..plans.lifecycle import rule_scores_prepared
from ..sources.tsv import id_lists


def match_stream(arriving: DataFrame, pool: DataFrame, out: str, checkpoint: str, threshold: float = 0.8, score: Callable[[DataFrame, DataFrame], DataFrame] = rule_scores_prepared) -> StreamingQuery:
    """Writes matching rows of each micro-batch under out/batch=N; a batch that is tried again replaces its own output.

    The pool's views are computed once, when the query starts, and stored beside the checkpoint; score takes them as they are.
    """
    text.prepare(pool).write.mode("overwrite").parquet(f"{checkpoint}-pool")
    ready = arriving.sparkSession.read.parquet(f"{checkpoint}-pool")

    def one(batch: DataFrame, number: int) -> None:
        matches = decision.accepted(score(batch, ready), decision.Decision(threshold=threshold))
        id_lists(batch, matches, "matched_entity_ids").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
