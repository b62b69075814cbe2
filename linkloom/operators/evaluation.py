"""Entity-level F0.5 and what rolls up from it, on an explicit set of entities; recall and size of candidate sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BETA2 = 0.25


def f_half(tp: Column, n_pred: Column, n_truth: Column) -> Column:
    """F0.5 of counts; two empty sets score 1."""
    precision, recall = tp / n_pred, tp / n_truth
    return F.when((n_pred == 0) & (n_truth == 0), F.lit(1.0)).when(tp == 0, F.lit(0.0)).otherwise((1 + BETA2) * precision * recall / (BETA2 * precision + recall))


def judged(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """(rid, gid, source, pred, truth): the union of both pair sets. The source is read off the id's prefix."""
    pred = matches.select("rid", "gid").withColumn("pred", F.lit(1)).withColumn("truth", F.lit(0))
    true = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).withColumn("pred", F.lit(0)).withColumn("truth", F.lit(1))
    return pred.unionByName(true).groupBy("rid", "gid").agg(F.max("pred").alias("pred"), F.max("truth").alias("truth")).withColumn("source", F.substring_index("gid", "-", 1))


def entity_scores(matches: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(rid, tp, fp, fn, n_pred, n_truth, f05) of each entity (entity_id), also of those without any pair."""
    counts = judged(matches, truth).groupBy("rid").agg(F.sum(F.col("pred") * F.col("truth")).alias("tp"), F.sum("pred").alias("n_pred"), F.sum("truth").alias("n_truth"))
    whole = entities.select(F.col("entity_id").alias("rid")).distinct().join(counts, "rid", "left").fillna(0, ["tp", "n_pred", "n_truth"])
    return whole.select("rid", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_truth") - F.col("tp")).alias("fn"), "n_pred", "n_truth", f_half(F.col("tp"), F.col("n_pred"), F.col("n_truth")).alias("f05"))


def summary(scores: DataFrame) -> DataFrame:
    """One row: macro and micro figures, singletons and matched entities apart."""
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    rate = lambda a, b: F.when(a + b > 0, a / (a + b)).otherwise(F.lit(0.0))
    return scores.agg(
        F.avg("f05").alias("macro_f05"), rate(tp, fp).alias("precision"), rate(tp, fn).alias("recall"), F.count(F.lit(1)).alias("n_entities"), F.sum((F.col("n_truth") > 0).cast("long")).alias("n_entities_with_truth"),
        F.coalesce(F.avg(F.when(F.col("n_truth") == 0, F.col("f05"))), F.lit(0.0)).alias("singleton_score"), F.coalesce(F.avg(F.when(F.col("n_truth") > 0, F.col("f05"))), F.lit(0.0)).alias("match_score"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), F.sum("n_pred").alias("n_predicted_pairs"),
    )


def by_source(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """Micro precision, recall and F0.5 for each source."""
    counts = judged(matches, truth).groupBy("source").agg(
        F.sum(F.col("pred") * F.col("truth")).alias("tp"), F.sum(F.col("pred") * (1 - F.col("truth"))).alias("fp"), F.sum((1 - F.col("pred")) * F.col("truth")).alias("fn")
    )
    p = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    r = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    rated = counts.withColumn("precision", p).withColumn("recall", r)
    low = BETA2 * F.col("precision") + F.col("recall")
    return rated.withColumn("f05", F.when(low > 0, (1 + BETA2) * F.col("precision") * F.col("recall") / low).otherwise(F.lit(0.0)))


def by_country(scores: DataFrame, s1: DataFrame) -> DataFrame:
    """Macro score for each country of the clean records; no country is (empty)."""
    named = s1.select(F.col("entity_id").alias("rid"), F.when(F.col("country") == "", "(empty)").otherwise(F.col("country")).alias("country"))
    return scores.join(named, "rid").groupBy("country").agg(F.avg("f05").alias("macro_f05"), F.count(F.lit(1)).alias("n"))


def candidate_recall(pairs: DataFrame, truth: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """One row: true pairs found and in all, recall, pairs, and how far the pairs fall short of all pairs. Measured before any injection."""
    want = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).distinct()
    found = want.join(pairs.select("rid", "gid").distinct(), ["rid", "gid"], "left_semi").agg(F.count(F.lit(1)).alias("found"))
    sizes = [want.agg(F.count(F.lit(1)).alias("total")), pairs.agg(F.count(F.lit(1)).alias("n_pairs")), s1.agg(F.count(F.lit(1)).alias("n1")), pool.agg(F.count(F.lit(1)).alias("n2"))]
    one = found
    for s in sizes:
        one = one.join(s, F.lit(True))  # single rows
    return one.select("found", "total", (F.col("found") / F.greatest("total", F.lit(1))).alias("recall"), "n_pairs", (1 - F.col("n_pairs") / F.greatest(F.col("n1") * F.col("n2"), F.lit(1))).alias("reduction_ratio"))


def recall_by(pairs: DataFrame, truth: DataFrame, s1: DataFrame, by: str) -> DataFrame:
    """Recall of true pairs by the candidate's source or by the clean record's country."""
    want = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).distinct()
    marked = want.join(pairs.select("rid", "gid").distinct().withColumn("hit", F.lit(1)), ["rid", "gid"], "left")
    if by == "source":
        marked = marked.withColumn("source", F.substring_index("gid", "-", 1))
    else:
        marked = marked.join(s1.select(F.col("entity_id").alias("rid"), F.when(F.col("country") == "", "(empty)").otherwise(F.col("country")).alias("country")), "rid")
    return marked.groupBy(by).agg(F.count("hit").alias("found"), F.count(F.lit(1)).alias("total"), (F.count("hit") / F.count(F.lit(1))).alias("recall"))


def candidate_distribution(pairs: DataFrame, s1: DataFrame, with_zero: bool = True) -> DataFrame:
    """Mean, median, 95th and 99th percentile (linear) and largest number of candidates of a clean record, those with none counted or not."""
    counts = pairs.groupBy("rid").agg(F.count(F.lit(1)).alias("n"))
    if with_zero:
        counts = s1.select(F.col("entity_id").alias("rid")).join(counts, "rid", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    q = F.percentile("n", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    return counts.agg(F.avg("n").alias("mean"), q.alias("q"), F.max("n").alias("max"), F.count(F.lit(1)).alias("entities")).select("entities", "mean", F.col("q")[0].alias("median"), F.col("q")[1].alias("p95"), F.col("q")[2].alias("p99"), "max")


def block_recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """For each block (bit): pairs, true pairs among them, recall over all true pairs, pairs for each entity that has one."""
    want = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).distinct()
    total = want.agg(F.count(F.lit(1)).alias("total"))
    marked = found.join(want.withColumn("hit", F.lit(1)), ["rid", "gid"], "left")
    each = marked.groupBy("bit").agg(F.count(F.lit(1)).alias("pairs"), F.count("hit").alias("positives"), F.countDistinct("rid").alias("entities"))
    return each.join(total, F.lit(True)).select("bit", "pairs", "positives", (F.col("positives") / F.greatest("total", F.lit(1))).alias("recall"), (F.col("pairs") / F.col("entities")).alias("mean_pairs"))


def block_table(found: DataFrame, truth: DataFrame, s1: DataFrame, bits: dict[str, int]) -> DataFrame:
    """For each named block alone: pairs, true pairs among them, recall over all true pairs, and mean, 95th and 99th percentile of its pairs for
    a clean record, those with none counted. found: rid, gid, blocks (mask)."""
    want = truth.select(F.col("s1_id").alias("rid"), F.col("entity_id").alias("gid")).distinct()
    names = F.array(*[F.struct(F.lit(n).alias("block"), F.lit(b).alias("bit")) for n, b in bits.items()])
    each = found.join(want.withColumn("hit", F.lit(1)), ["rid", "gid"], "left").select("rid", "blocks", "hit", F.explode(names).alias("b")).where(F.col("blocks").bitwiseAND(F.col("b.bit")) != 0)
    counts = each.groupBy("rid", F.col("b.block").alias("block")).agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"))
    grid = s1.select(F.col("entity_id").alias("rid"), F.explode(F.array(*[F.lit(n) for n in bits])).alias("block")).join(counts, ["rid", "block"], "left").fillna(0, ["n", "hits"])
    q = F.percentile("n", F.array(F.lit(0.95), F.lit(0.99)))
    rows = grid.groupBy("block").agg(F.sum("n").alias("pairs"), F.sum("hits").alias("positives"), F.avg("n").alias("mean"), q.alias("q"))
    total = want.agg(F.count(F.lit(1)).alias("total"))
    return rows.join(total, F.lit(True)).select("block", "pairs", "positives", (F.col("positives") / F.greatest("total", F.lit(1))).alias("recall"), "mean", F.col("q")[0].alias("p95"), F.col("q")[1].alias("p99"))
