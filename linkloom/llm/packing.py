"""Packing: optimal length buckets by dynamic programming over the global histogram, and token-budget batches in each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, materialize, whole_text

BUCKETS = 16
#: Padded tokens of a batch; a longer text is cut into pieces of this size.
TOKEN_BUDGET = 32_768
#: Rows of a bucket that are batched together: bounds the rows of one window, and costs one batch that isn't full for each.
SHARD = 8_192


def n_words(text):
    return F.size(F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")).cast("long")


def optimal_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most `buckets` buckets with the least padding, each row padded to its bucket's bound.

    lengths: distinct, ascending; counts: rows of each. best[j] is the least padded size of the first j lengths; a bucket over
    lengths i to j-1 takes lengths[j-1] for each of its rows (what is padded, less a constant). For one j that is a
    minimum over lines in lengths[j-1], one for each i, with slope -rows[i]; slopes fall and lengths rise, so a lower hull
    answers all j of a round in linear time. Whole numbers throughout, so ties are exact.
    """
    n = len(lengths)
    if not n:
        return []
    size = [int(x) for x in lengths]
    rows = [0, *np.cumsum(np.asarray(counts, dtype=np.int64)).tolist()]
    best: list[int | None] = [0] + [None] * n
    cuts = []
    for _ in range(min(buckets, n)):
        new, cut, hull, at = [0] + [None] * n, [0] * (n + 1), [], 0
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                slope, offset = -rows[j - 1], best[j - 1]
                # the middle line is never lowest if the new one passes the one before it no later
                while len(hull) > 1 and (offset - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - slope):
                    hull.pop()
                hull.append((slope, offset, j - 1))
            at = min(at, len(hull) - 1)
            x = size[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                at += 1
            new[j], cut[j] = hull[at][0] * x + hull[at][1] + x * rows[j], hull[at][2]
        best = new
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(size[j - 1])
        j = cut[j]
    return sorted(bounds)


def packed(docs: DataFrame, buckets: int = BUCKETS, budget: int = TOKEN_BUDGET, shard: int = SHARD, n_tokens: Column | None = None) -> DataFrame:
    """One row per piece of a text: doc_id, piece, first_token, n_tokens, bucket, bucket_len, batch_id, slot, batch_rows.

    A token is a word between ASCII spaces; n_tokens, a column expression over docs, gives other counts, such as those of the byte
    encoding (null: none). A text over the budget is cut into pieces of that size, so nothing is lost;
    others have one piece. Null and empty texts have one piece without tokens. A batch holds rows of one bucket only, and
    rows times bucket_len is at most the budget. Repeated rows are packed each; a null doc_id stays null; an empty table gives
    no rows; other columns are not read. Which rows share a batch follows from a hash of the id, so it is
    the same in each run and spread over sources.
    """
    lens = docs.select("doc_id", (n_words(whole_text()) if n_tokens is None else F.coalesce(n_tokens.cast("long"), F.lit(0))).alias("n"))
    parts = F.greatest(F.ceil(F.col("n") / budget), F.lit(1)).cast("long")
    pieces = lens.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("piece"))
    pieces = materialize(pieces.select("doc_id", "piece", (F.col("piece") * budget).alias("first_token"), F.least(F.lit(budget), F.col("n") - F.col("piece") * budget).cast("long").alias("n_tokens")))
    bins = pieces.groupBy(F.col("n_tokens").alias("top")).agg(F.count(F.lit(1)).alias("rows")).orderBy("top").toPandas()  # at most budget + 1 rows
    bounds = optimal_boundaries(bins["top"].to_numpy(), bins["rows"].to_numpy(), buckets)
    which = np.searchsorted(bounds, bins["top"].to_numpy()) if bounds else np.empty(0, dtype=int)
    shards = [max(1, -(-int(bins["rows"][which == k].sum()) // shard)) for k in range(len(bounds))]
    of = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values] or [F.lit(1)]), F.col("bucket") + 1)
    bucket = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds), F.lit(0)).cast("int")
    placed = pieces.withColumn("bucket", bucket).withColumn("bucket_len", of(bounds).cast("long"))
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), of(shards).cast("long"))).withColumn("fits", F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))).cast("long"))
    order = Window.partitionBy("bucket", "shard").orderBy(F.xxhash64("piece", "doc_id"), "doc_id", "piece")
    numbered = placed.withColumn("rn", F.row_number().over(order).cast("long") - 1).withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket", "shard")))
    batch = F.floor(F.col("rn") / F.col("fits")).cast("long")
    return numbered.select(
        "doc_id", "piece", "first_token", "n_tokens", "bucket", "bucket_len", F.format_string("%d-%d-%d", F.col("bucket"), F.col("shard"), batch).alias("batch_id"),
        (F.col("rn") % F.col("fits")).alias("slot"), F.least(F.col("fits"), F.col("size") - batch * F.col("fits")).alias("batch_rows"),
    )
