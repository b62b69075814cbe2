"""The 25 features of a pair, in one projection after two equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaro_pair, levenshtein_ratio

# The names of the features, in order.
FEATURES = [
    "name_exact", "name_heavy_exact", "name_core_exact", "name_jw", "name_jaro", "name_lev_ratio", "name_token_jaccard", "name_partial", "name_len_ratio",
    "addr_exact", "addr_jw", "addr_lev_ratio", "addr_token_jaccard", "addr_len_ratio", "house_match", "postal_match", "country_equal", "country_conflict",
    "block_count", "block_mask", "high_name_high_addr", "name_addr_product", "name_present", "addr_present", "source_is_s3",
]
VIEWS = ["name", "name_heavy", "name_core", "addr", "house", "postal", "country"]
#: Weights of the rule score, a stand-in for a trained model that SQL can state too.
RULE = {"name_jw": 0.4, "addr_jw": 0.2, "name_core_exact": 0.15, "house_match": 0.1, "postal_match": 0.1, "country_equal": 0.05}
DIGITS = 6


def _same(a: Column, b: Column) -> Column:
    return ((a != "") & (a == b)).cast("int")


def token_coverage(a: Column, b: Column) -> Column:
    """Common distinct tokens over distinct tokens of a; an untrimmed name has an empty token that counts."""
    x, y = F.split(a, " "), F.split(b, " ")
    share = F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_distinct(x)), F.lit(1))
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(share)


def joined(pairs: DataFrame, s1: DataFrame, pool: DataFrame, views: list[str] = VIEWS) -> DataFrame:
    """Pairs with the views of both records as s_* and c_*. Views are cut to what features read before the joins."""
    left = s1.select(F.col("entity_id").alias("rid"), *[F.col(v).alias(f"s_{v}") for v in views])
    right = pool.select(F.col("entity_id").alias("gid"), *[F.col(v).alias(f"c_{v}") for v in views])
    return pairs.join(right, "gid").join(left, "rid")  # a clean record's pairs stand together, so that a batch scores equal strings once


def pair_features(pairs: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """rid, gid, source and FEATURES. Each pair of strings goes to the similarity function once."""
    c = lambda side, v: F.col(f"{side}_{v}")
    both = joined(pairs, s1, pool).withColumn("_n", jaro_pair(c("s", "name"), c("c", "name"))).withColumn("_a", jaro_pair(c("s", "addr"), c("c", "addr")))
    len_ratio = lambda v: F.least(F.length(c("s", v)), F.length(c("c", v))) / F.greatest(F.length(c("s", v)), F.length(c("c", v)), F.lit(1))
    name_jw, addr_jw = F.col("_n.jaro_winkler"), F.col("_a.jaro_winkler")
    values = {
        "name_exact": _same(c("s", "name"), c("c", "name")), "name_heavy_exact": _same(c("s", "name_heavy"), c("c", "name_heavy")), "name_core_exact": _same(c("s", "name_core"), c("c", "name_core")),
        "name_jw": name_jw, "name_jaro": F.col("_n.jaro"), "name_lev_ratio": levenshtein_ratio(c("s", "name"), c("c", "name")), "name_token_jaccard": token_coverage(c("s", "name"), c("c", "name")),
        "name_partial": name_jw, "name_len_ratio": len_ratio("name"), "addr_exact": _same(c("s", "addr"), c("c", "addr")), "addr_jw": addr_jw,
        "addr_lev_ratio": levenshtein_ratio(c("s", "addr"), c("c", "addr")), "addr_token_jaccard": token_coverage(c("s", "addr"), c("c", "addr")), "addr_len_ratio": len_ratio("addr"),
        "house_match": _same(c("s", "house"), c("c", "house")), "postal_match": _same(c("s", "postal"), c("c", "postal")), "country_equal": _same(c("s", "country"), c("c", "country")),
        "country_conflict": ((c("s", "country") != "") & (c("c", "country") != "") & (c("s", "country") != c("c", "country"))).cast("int"),
        "block_count": F.col("block_count"), "block_mask": F.col("block_mask"), "high_name_high_addr": ((name_jw >= 0.90) & (addr_jw >= 0.85)).cast("int"), "name_addr_product": name_jw * addr_jw,
        "name_present": (c("s", "name") != "").cast("int"), "addr_present": ((c("s", "addr") != "") & (c("s", "addr") != " ")).cast("int"), "source_is_s3": (F.col("source") == "S3").cast("int"),
    }
    return both.select("rid", "gid", "source", *[values[f].alias(f) for f in FEATURES])


def rounded(features: DataFrame) -> DataFrame:
    """Doubles to DIGITS, for comparison across engines."""
    return features.select(*[F.round(c, DIGITS).alias(c) if t == "double" else F.col(c) for c, t in features.dtypes])


def rule_score(features: DataFrame) -> DataFrame:
    """rid, gid, source, p: the weighted sum of RULE, rounded."""
    total = sum((F.col(f).cast("double") * w for f, w in RULE.items()), F.lit(0.0))
    return features.select("rid", "gid", "source", F.round(total, DIGITS).alias("p"))
